"""The registered queries of this subpackage, each over the whole of its table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagesift.llm import alignment, article, chunk_table, cover_tree, encoding, jaccard, language, lines, packing, quality, secret_scan, segment_search, trie
from pagesift.llm.common import read_table

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read_table(spark, sf_dir, "documents")
    rows = secret_scan.with_spans(documents, secret_scan.train(documents))
    base = F.filter("secret_spans", lambda s: s["kind"] < 3)

    def number(kind: int):
        return F.size(F.filter("secret_spans", lambda s: s["kind"] == kind)).cast("long")

    return rows.select(
        "doc_id",
        number(0).alias("n_assign"),
        number(1).alias("n_access"),
        number(2).alias("n_hex"),
        number(3).alias("n_markov"),
        F.sha2(secret_scan.spans_text(base), 256).alias("base_sha256"),
        secret_scan.spans_text(F.col("secret_spans")).alias("spans"),
    )


def op2_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cover_tree.linked_vectors(read_table(spark, sf_dir, "embeddings"))


def op3_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return segment_search.top_k(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read_table(spark, sf_dir, "documents")
    return packing.packed(documents, encoding.send_encoder(spark, documents, TOKENIZER))


def op10_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read_table(spark, sf_dir, "documents")
    rows = encoding.with_ids(documents, encoding.send_encoder(spark, documents, TOKENIZER), decoded=True)
    return rows.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op11_sentencepiece_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = chunk_table.with_ids(read_table(spark, sf_dir, "documents"), PIECES, decoded=True)
    return rows.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op12_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.prefix_trie(read_table(spark, sf_dir, "conversations"), trie.Lending(group=100, most=6))


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = alignment.aligned(read_table(spark, sf_dir, "documents"), TOKENIZER, PIECES)
    digest = F.when(F.col("groups") == "", "").otherwise(F.sha2("groups", 256))
    return rows.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", digest.alias("groups_sha256"))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read_table(spark, sf_dir, "documents")
    held_out = F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(5)) == 0, F.lit(False))
    learnable = F.col("doc_id").isNotNull() & ~held_out
    found = language.with_language(documents, language.learn(documents, learnable))
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "rejected")


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read_table(spark, sf_dir, "documents")
    return quality.with_quality(documents, quality.train(documents)).select("doc_id", "quality_score", "kept")


def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.linked_documents(read_table(spark, sf_dir, "documents"), jaccard.Similarity(words=3, share=90))


def op8_article_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return article.with_main_text(read_table(spark, sf_dir, "pages")).withColumn("n_chars", F.length("text").cast("long"))


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read_table(spark, sf_dir, "documents")
    return lines.without_repeats(documents).select("doc_id", "text", "n_lines", "n_removed")


QUERIES = {
    f.__name__: f
    for f in (
        op1_secret_scan,
        op2_embedding_near_dedup,
        op3_exact_top_k,
        op4_best_fit_packing,
        op5_language_id,
        op6_quality_classifier,
        op7_jaccard_join,
        op8_article_text,
        op9_line_dedup,
        op10_bpe_round_trip,
        op11_sentencepiece_round_trip,
        op12_conversation_trie,
        op13_token_alignment,
    )
}

_FINITE = "embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0"

ORACLES: dict[str, str] = {
    "op2_embedding_near_dedup": f"""
WITH RECURSIVE v AS (
  SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings WHERE {_FINITE} AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), w AS (SELECT vec_id, e, sqrt(list_inner_product(e, e)) AS n FROM v),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM w a JOIN w b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_inner_product(a.e, b.e) / (a.n * b.n) >= 0.95
), reach AS (
  SELECT vec_id AS id, vec_id AS c FROM embeddings
  UNION SELECT l.b, r.c FROM reach r JOIN links l ON r.id = l.a
), least AS (SELECT id, min(c) AS c FROM reach GROUP BY id)
SELECT e.vec_id, count(l.b) AS n_links, any_value(m.c) AS component_id, e.vec_id = any_value(m.c) AS kept
FROM embeddings e JOIN least m ON m.id = e.vec_id LEFT JOIN links l ON l.a = e.vec_id GROUP BY e.vec_id
""",
    # crc32 of the decimal id bit by bit: the reflected polynomial 0xEDB88320 = 3988292384, complement 4294967295
    "op12_conversation_trie": r"""
WITH RECURSIVE t AS (
  SELECT conv_id AS c, coalesce(role, '') AS r, coalesce(text, '') AS x,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS i FROM conversations WHERE conv_id IS NOT NULL
), crc AS (
  SELECT c, c::VARCHAR AS s, 0 AS k, 4294967295::UBIGINT AS v FROM (SELECT DISTINCT c FROM t)
  UNION ALL SELECT c, s, k + 1, list_reduce(
    list_prepend(xor(v, ascii(substr(s, k + 1, 1))::UBIGINT), [0::UBIGINT, 0, 0, 0, 0, 0, 0, 0]),
    lambda a, z: CASE WHEN a % 2 = 1 THEN xor(a // 2, 3988292384::UBIGINT) ELSE a // 2 END) FROM crc WHERE k < length(s)
), h AS (SELECT c, (xor(v, 4294967295::UBIGINT) % 6)::BIGINT AS h FROM crc WHERE k = length(s)),
rebuilt AS (
  SELECT h.c, 0 AS own, t.i, t.r, t.x FROM h JOIN t ON t.c = h.c - h.c % 100 AND t.i <= h.h
  UNION ALL SELECT h.c, 1, t.i, t.r, t.x FROM h JOIN t ON t.c = h.c AND t.i > h.h
), turns AS (
  SELECT c, row_number() OVER w AS d, r, x,
    md5(string_agg(length(r) || ':' || length(x) || ':' || r || x, '') OVER w) AS p FROM rebuilt WINDOW w AS (PARTITION BY c ORDER BY own, i)
), steps AS (
  SELECT c, d, p, coalesce(lag(p) OVER (PARTITION BY c ORDER BY d), '') AS q, length(x) AS n FROM turns
  UNION ALL SELECT c, 0, '', NULL, 0 FROM h
), nodes AS (SELECT d, p, any_value(q) AS q, min(c) AS c, count(*) AS n_convs, any_value(n) AS n FROM steps GROUP BY d, p),
children AS (SELECT d - 1 AS d, q AS p, count(*) AS k FROM nodes WHERE d > 0 GROUP BY ALL),
full_nodes AS (SELECT n.*, coalesce(k, 0) AS k FROM nodes n LEFT JOIN children USING (d, p)),
below AS (
  SELECT a.d, a.p, sum((b.k = 0)::BIGINT) AS n_leaves, sum((b.n_convs - 1) * b.n) AS saved
  FROM full_nodes b JOIN steps s ON s.c = b.c AND s.d <= b.d JOIN nodes a ON a.d = s.d AND a.p = s.p GROUP BY ALL
), ends AS (
  SELECT d, p, sha256(string_agg(c::VARCHAR, ',' ORDER BY c)) AS e FROM steps
  WHERE (c, d) IN (SELECT (c, max(d)) FROM steps GROUP BY c) GROUP BY ALL
)
SELECT n.c AS conv_id, n.d::BIGINT AS depth, (SELECT m.c FROM nodes m WHERE m.d = n.d - 1 AND m.p = n.q) AS parent_conv_id, n.n_convs, n.k AS n_children,
  b.n_leaves::BIGINT AS n_leaves, b.saved::BIGINT AS saved_tokens, coalesce(e.e, sha256('')) AS ends_sha256
FROM full_nodes n JOIN below b USING (d, p) LEFT JOIN ends e USING (d, p)
""",
    "op3_exact_top_k": f"""
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS e FROM embeddings WHERE vec_id IS NOT NULL AND {_FINITE}
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e) WHERE q.vec_id % 100 = 0
)
SELECT query_id, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INTEGER AS rank, vec_id, score
FROM s QUALIFY rank <= 10
""",
    "op7_jaccard_join": r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS w FROM documents
), s AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [list_aggregate(w, 'string_agg', ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) END AS s FROM w
), e AS (SELECT doc_id, len(s) AS n, unnest(s) AS x FROM s),
both_have AS (SELECT a.doc_id AS a, b.doc_id AS b, any_value(a.n) AS n, any_value(b.n) AS m, count(*) AS k
  FROM e a JOIN e b ON a.x = b.x AND a.doc_id <> b.doc_id AND 10 * least(a.n, b.n) >= 9 * greatest(a.n, b.n) GROUP BY 1, 2),
links AS (SELECT a, b FROM both_have WHERE 100 * k >= 90 * (n + m - k)),
reach AS (SELECT doc_id AS id, doc_id AS c FROM s UNION SELECT l.b, r.c FROM reach r JOIN links l ON r.id = l.a)
SELECT s.doc_id, len(s.s)::BIGINT AS n_shingles, min(r.c) AS component_id FROM s JOIN reach r ON r.id = s.doc_id GROUP BY ALL
""",
}
