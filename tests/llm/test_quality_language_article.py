"""Trained operators on held-out rows and planted cases, and the pipeline from end to end."""

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from pagesift.llm import article, language, quality
from pagesift.llm.queries import op5_language_id, op6_quality_classifier, op8_article_text


def test_labels_agree_with_quality(spark, testdata):
    found = op6_quality_classifier(spark, f"{testdata}/sf0.1")
    rows = found.join(spark.read.parquet(f"{testdata}/sf0.1/labels.parquet"), "doc_id").collect()
    good = [r.kept for r in rows if r.quality == 1]
    bad = [r.kept for r in rows if r.quality == 0]
    assert sum(good) > 0.995 * len(good)
    assert sum(bad) < 0.1 * len(bad)


def test_quality_of_odd_rows(spark):
    prose = "The first line of a plain text has words. It goes on for a while, and ends.\nAnother line follows it here."
    rows = [(1, prose, "x"), (1, prose, "x"), (2, None, "x"), (3, "", None), (4, " \n", "x"), (None, "SHOUT!! " * 40, "x"), (6, "ab " * 40_000, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, code string")
    model = quality.train(df)
    got = quality.with_quality(df, model)
    assert got.columns == [*df.columns, "quality_score", "kept"]
    rows = got.collect()
    assert len(rows) == 7
    assert all(not r.kept and r.quality_score == 0.0 for r in rows if not (r.text or "").strip())
    empty = df.where("false")
    assert quality.with_quality(empty, quality.train(empty)).count() == 0


def test_estimated_accuracies():
    rng = np.random.default_rng(5)
    truth = rng.random(6000) < 0.8
    right = [0.95, 0.9, 0.85, 0.8, 0.75, 0.7, 0.9, 0.8]
    counts = {}
    codes = []
    for t in truth:
        v = tuple(2 if rng.random() < 0.2 else int(t if rng.random() < a else not t) for a in right)
        codes.append(quality.code_of(v))
        counts[codes[-1]] = counts.get(codes[-1], 0) + 1
        assert quality.votes_of(codes[-1]) == v
    posterior, chance = quality.estimate(counts)
    assert np.mean([(posterior[c] >= 0.5) == t for c, t in zip(codes, truth)]) > 0.97
    for k, a in enumerate(right):
        assert abs(chance[1, k, 1] / (1 - chance[1, k, 2]) - a) < 0.05


def test_language_of_held_out_rows(spark, testdata):
    found = op5_language_id(spark, f"{testdata}/sf0.1")
    rows = found.join(spark.read.parquet(f"{testdata}/sf0.1/documents.parquet").select("doc_id", "lang", "text"), "doc_id").where("held_out").collect()
    assert np.mean([r.lang == r.lang_pred for r in rows]) > 0.97
    long = [r for r in rows if len(r.text) > 200]
    assert np.mean([r.lang == r.lang_pred for r in long]) > 0.98
    assert all(0 <= r.score <= 1 for r in rows)


def test_language_of_odd_rows(spark, testdata):
    docs = spark.read.parquet(f"{testdata}/sf0.01/documents.parquet")
    model = language.learn(docs, F.lit(True))
    rows = [(1, None, "en"), (2, "", "en"), (3, "12 !! 34", "en"), (4, "ß", None), (5, "the and of the that with " * 20_000, "xx"), (5, "der die und das " * 9, "de")]
    df = spark.createDataFrame(rows, "doc_id long, text string, score string")
    got = [(r.doc_id, r.lang_pred, r.score) for r in language.with_language(df, model).orderBy("doc_id", F.desc("lang_pred")).collect()]
    assert [g[1] for g in got[:3]] == ["und"] * 3 and got[3][1] in model.languages
    assert [g[1] for g in got[4:]] == ["en", "de"]
    none = language.learn(docs, F.lit(False))
    assert {r.lang_pred for r in language.with_language(df, none).collect()} == {"und"}
    assert language.with_language(df.where("false"), model).count() == 0


PAGE = """<!DOCTYPE html><html><head><title>T &amp; t</title><style>p{}</style><script>var a="<p>no</p>";</script></head><body class="home">
<header class="top"><h1>Site name</h1></header><nav><ul><li><a href="/">Home</a></li><li><a href="/a">About us</a></li></ul></nav>
<div class="cookie-notice">We use cookies to make this site work for you.</div><!-- <p>comment</p> --><div class=ad>Buy now, it is cheap.</div>
<article><header><h1>The &lt;title&gt; of it</h1></header><p>First   paragraph with <b>bo</b>ld text &amp; more&nbsp;words.<br>Same block<p title="a > b">Second one.</p>
<form><p>Your mail</p><input name=q></form><blockquote><p>A quote, short.</p></blockquote><div id="comments"><p>I like this article very much, thank you.</p></div></article>
<aside><p>Related reading that is long enough to look like text in its own right.</p></aside><footer>&copy; 2020 Site</footer>"""


def test_article_of_a_page():
    tree = article.trained()
    want = "The <title> of it\n\nFirst paragraph with bold text & more words. Same block\n\nSecond one.\n\nA quote, short."
    assert article.main_text(PAGE, tree) == want
    assert article.main_text(PAGE[: PAGE.index("Second")] + "Second", tree).endswith("Same block\n\nSecond")


def test_article_without_names():
    text = "This paragraph has quite a few words, and tells something that a reader of the page came to read in the end."
    page = f'<body><div><a href="a">Home</a></div><div><a href="b">News</a> <a href="c">More</a></div><h2>A heading here</h2><div>{text}</div><div>{text}</div><div><a href="d">Next</a></div></body>'
    assert article.main_text(page, article.trained()) == f"A heading here\n\n{text}\n\n{text}"


def test_every_labelled_block_is_learned():
    tree = article.trained()
    assert all(article.judge(tree, np.array(row[:-1], float)) == row[-1] for row in article.LABELLED)


def test_articles_of_odd_rows(spark, testdata):
    rows = [(1, None, None), (2, "u", ""), (3, "u", "<" * 5000), (4, "u", "<p 'x" * 3000), (5, "u", "no markup at all but some words to be read here by anyone at all, yes"), (5, "u", "<article>" + "<p>w " * 20_000)]
    df = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, text string")
    got = sorted(((r.page_id, len(r.text)) for r in article.with_main_text(df).collect()))
    assert len(got) == 6 and got[0] == (1, 0) and got[1] == (2, 0) and got[5][1] == 20_000 * 3 - 2
    assert article.with_main_text(df.where("false")).count() == 0


def test_articles_of_the_table(spark, testdata):
    import html
    import re

    pages = {r.page_id: r.html for r in spark.read.parquet(f"{testdata}/sf0.01/pages.parquet").collect()}
    for r in op8_article_text(spark, f"{testdata}/sf0.01").collect():
        inner = re.search(r"<article>(.*)</article>", pages[r.page_id], re.S)[1]
        parts = [" ".join(html.unescape(re.sub(r"</?b>", "", p)).split()) for p in re.split(r"</?(?:h1|p|br)>", inner)]
        assert r.text.split() == " ".join(p for p in parts if p).split()
        assert r.n_chars == len(r.text)


def test_pipeline(spark, testdata, tmp_path):
    docs = spark.read.parquet(f"{testdata}/sf0.01/documents.parquet")
    rows, columns = docs, docs.columns
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{testdata}/sf0.01/labels.parquet").collect()}
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, rows, f"{testdata}/sf0.01").write.parquet(str(tmp_path / name))
        rows = spark.read.parquet(str(tmp_path / name))
        if name != "packing":
            assert rows.columns == columns
        kept[name] = {r.doc_id for r in rows.select("doc_id").collect()}
    names = list(kept)
    assert all(kept[b] <= kept[a] for a, b in zip(names, names[1:]))
    assert kept["secrets"] == kept["near_copies"] == kept["packing"]
    assert all(i in kept["quality"] for i, q in labels.items() if q == 1)
    texts = {r.doc_id: r.text for r in docs.collect()}
    first = {}
    for i in sorted(kept["quality"]):
        first.setdefault(texts[i], i)
    assert all(first[texts[i]] == i for i in kept["line_dedup"] if len(texts[i].split()) >= 8 and "\n" not in texts[i])


def test_pipeline_of_empty_table(spark, testdata):
    rows = spark.read.parquet(f"{testdata}/sf0.001/documents.parquet").where("false")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, rows, f"{testdata}/sf0.001").count() == 0


@pytest.mark.parametrize("name", ["op5_language_id", "op6_quality_classifier"])
def test_one_row_each(spark, testdata, name):
    from pagesift.llm.queries import QUERIES

    assert QUERIES[name](spark, f"{testdata}/sf0.001").count() == spark.read.parquet(f"{testdata}/sf0.001/documents.parquet").count()
