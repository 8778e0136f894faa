"""Training samples hold distinct texts: copies neither fill them nor empty them."""

from pyspark.sql import functions as F

from pagesift.llm import common, language, quality


def test_least_hashes(spark):
    rows = [("a", k % 700 * 2**53 - 2**62) for k in range(2100)] + [("b", 5)] * 900 + [("c", -k) for k in range(3)]
    df = spark.createDataFrame(rows, "l string, h long")
    want = {name: sorted({h for n, h in rows if n == name}) for name in "abc"}
    for limit in (1, 40, 5000):
        assert common.least_hashes(df, limit) == {name: h[:limit][-1] for name, h in want.items()}
    assert common.least_hashes(df.where("false"), 3) == {}


def test_a_language_of_copies_is_learned(spark):
    made = [(" ".join(f"wort{k * j % 97} und" for j in range(1, 30)) + f" {k}", "de") for k in range(40)]
    spark_rows = spark.createDataFrame([(f"the and of that with copy {k}",) for k in range(50)], "t string")
    # a text that the old sample, one of so many hashes, did not take
    copy = spark_rows.where(F.pmod(F.xxhash64("t"), F.lit(200)) != 0).first().t
    df = spark.createDataFrame([*made, *[(copy, "en")] * 2000], "text string, lang string")
    model = language.learn(df, F.lit(True), sample=10)
    assert model.languages == ("de", "en")
    assert model.dictionaries[1] == language.normalised(copy)


def test_copies_count_once_in_the_fitted_sample(spark, monkeypatch):
    sizes = []
    fit = quality.fit
    monkeypatch.setattr(quality, "fit", lambda rows: sizes.append(len(rows)) or fit(rows, rounds=1))
    other = [(k, f"The text of row {k} has words. It ends here, after some more of them.") for k in range(300)]
    for copies in range(4):  # the old sample took all rows of one text in 60 or none
        df = spark.createDataFrame([*other, *((k, f"One copy {copies} of this is much like another.") for k in range(2700))], "doc_id long, text string")
        quality.train(df, sample=50)
    quality.train(df.where("doc_id >= 300"), sample=50)
    assert sizes == [50, 50, 50, 50, 1]
