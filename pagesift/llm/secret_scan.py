"""Secrets in texts: fixed patterns, and random-looking strings by two character Markov models. JVM operators only.

A run of 16 or more key characters is a candidate. One Markov model (next character given this one) is trained on
labelled random strings, another on ordinary identifiers; a candidate is reported when the log-likelihood ratio of the
two is high enough. Both tables have a fixed size, so the model travels as one literal array.

Defined results: null and empty texts have no spans. Offsets count code points, the end is exclusive. Rows that repeat a
document are scanned each. A table without any random string to learn from reports pattern matches only.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# fixed values: the patterns, their kinds in order, and the least length of what counts
ASSIGN = r"""((?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?)([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
KINDS = ("assign", "access", "hex", "markov")
ASSIGN_LEAST, ACCESS_LEAST, HEX_LEAST = 6, 20, 24

CANDIDATE = r"[A-Za-z0-9+/_=-]+"
CANDIDATE_LEAST = 16
FIRST, WIDTH = 43, 80  # the table covers the code points '+' to 'z'
THRESHOLD = 12.0  # nats: a candidate is random when that is e**12 times as likely
SAMPLE_DOCUMENTS = 4_000


@dataclass(frozen=True)
class Model:
    """Log-likelihood ratio of every pair of characters, row by row."""

    ratios: tuple[float, ...]

    def column(self) -> Column:
        return F.expr("array(" + ",".join(f"{x:.6f}D" for x in self.ratios) + ")")


def _lengths(found: Column) -> Column:
    return F.transform(found, F.length)


def _spans(text: Column, pattern: str, kind: int, least: int, group: int = 0) -> Column:
    """Matches of ``pattern`` as (start, end, kind, value): the text is cut at the matches, whose places follow from
    the lengths of the pieces. Matches whose ``group`` is shorter than ``least`` are dropped."""
    pieces = F.split(text, pattern, -1)
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else matches
    zipped = F.arrays_zip(_lengths(pieces).alias("p"), _lengths(matches).alias("m"), values.alias("v"))
    # the running end goes along; the last piece has no match and adds nothing
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int,kind:int,value:string>>").alias("out"))
    folded = F.aggregate(
        zipped,
        start,
        lambda a, x: F.struct(
            (a["at"] + x["p"] + F.coalesce(x["m"], F.lit(0))).alias("at"),
            F.when(
                F.length(x["v"]) >= least,
                F.concat(
                    a["out"],
                    F.array(
                        F.struct(
                            (a["at"] + x["p"]).alias("start"),
                            (a["at"] + x["p"] + x["m"]).alias("end"),
                            F.lit(kind).alias("kind"),
                            x["v"].alias("value"),
                        )
                    ),
                ),
            )
            .otherwise(a["out"])
            .alias("out"),
        ),
        lambda a: a["out"],
    )
    none = F.array().cast("array<struct<start:int,end:int,kind:int,value:string>>")
    return F.when(F.regexp_like(text, F.lit(pattern)), folded).otherwise(none)


def _patterns(text: Column) -> dict[str, Column]:
    # a run of hexadecimal digits, of access characters and of key characters is longest as matched, so shorter ones
    # may be left out by the pattern itself; an assignment that is too short still takes its text with it
    return {
        "_assign": _spans(text, ASSIGN, 0, ASSIGN_LEAST, 2),
        "_access": _spans(text, rf"AKIA[A-Z0-9]{{{ACCESS_LEAST - 4},}}", 1, ACCESS_LEAST),
        "_hex": _spans(text, rf"[0-9a-f]{{{HEX_LEAST},}}", 2, HEX_LEAST),
    }


def _codes(token: Column) -> Column:
    return F.transform(F.split(token, ""), lambda c: F.ascii(c) - FIRST)


def train(documents: DataFrame, text: str = "text", sample: int = SAMPLE_DOCUMENTS, smoothing: float = 0.5) -> Model:
    """Models from labelled samples: the strings that the patterns find anywhere (random), and the key-character runs
    of eight or more in a sample of about ``sample`` documents, without those strings (ordinary). Each distinct string
    counts once, so copies of a document give it no more weight.

    The sample is taken by the hash of the text, so it is spread over all files and never meets in one task. Only counts of character pairs leave the tasks, at most 6,400 rows for each label.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    any_pattern = "|".join((ASSIGN, rf"AKIA[A-Z0-9]{{{ACCESS_LEAST - 4},}}", rf"[0-9a-f]{{{HEX_LEAST},}}"))
    hits = documents.select(whole.alias("t")).where(F.regexp_like("t", F.lit(any_pattern)))
    found = _patterns(F.col("t"))
    random = hits.select(
        F.lit(True).alias("random"), F.explode(F.transform(F.concat(*found.values()), lambda s: s["value"])).alias("s")
    )
    share = max(1, documents.count() // sample)
    some = documents.select(whole.alias("t")).where(F.pmod(F.xxhash64("t"), F.lit(share)) == 0)
    plain = some.select(
        F.lit(False).alias("random"),
        F.explode(F.regexp_extract_all(F.regexp_replace("t", any_pattern, " "), F.lit(r"[A-Za-z0-9+/_=-]{8,}"), F.lit(0))).alias("s"),
    )
    codes = random.unionByName(plain).distinct().select("random", _codes(F.col("s")).alias("c"))
    pairs = codes.select(
        "random", F.explode(F.zip_with(F.slice("c", 1, F.size("c") - 1), F.slice("c", 2, F.size("c")), lambda a, b: a * WIDTH + b)).alias("pair")
    )
    counts: dict[bool, list[float]] = {True: [0.0] * WIDTH**2, False: [0.0] * WIDTH**2}
    for row in pairs.groupBy("random", "pair").count().collect():
        if row.pair is not None and 0 <= row.pair < WIDTH**2:
            counts[row.random][row.pair] += row["count"]
    if not any(counts[True]):
        return Model((0.0,) * WIDTH**2)
    letters = 66  # characters that can follow
    ratios = []
    for a in range(WIDTH):
        rows = {k: counts[k][a * WIDTH : (a + 1) * WIDTH] for k in (True, False)}
        sums = {k: sum(v) + smoothing * letters for k, v in rows.items()}
        for b in range(WIDTH):
            p, q = ((rows[k][b] + smoothing) / sums[k] for k in (True, False))
            ratios.append(math.log(p / q))
    return Model(tuple(ratios))


def ratio(token: Column, table: Column) -> Column:
    """Log-likelihood ratio of a token made of key characters."""
    start = F.struct(F.lit(-1).alias("last"), F.lit(0.0).alias("sum"))
    return F.aggregate(
        _codes(token),
        start,
        lambda a, c: F.struct(
            c.alias("last"),
            F.when(a["last"] < 0, F.lit(0.0)).otherwise(a["sum"] + F.get(table, a["last"] * WIDTH + c)).alias("sum"),
        ),
        lambda a: a["sum"],
    )


def with_spans(documents: DataFrame, model: Model, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``documents`` with ``secret_spans``: (start, end, kind, value), by start and kind, kind as its place in KINDS.

    Spans of the patterns are all kept; a random-looking run is added where it meets none of them and is no number.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    rows = documents.withColumns({**_patterns(whole), "_ratios": model.column()})
    rows = rows.withColumn("_base", F.array_sort(F.concat("_assign", "_access", "_hex")))
    candidates = _spans(whole, rf"[A-Za-z0-9+/_=-]{{{CANDIDATE_LEAST},}}", 3, CANDIDATE_LEAST)
    markov = F.filter(
        candidates,
        lambda s: F.regexp_like(s["value"], F.lit("[A-Za-z]"))
        & (ratio(s["value"], F.col("_ratios")) >= threshold)
        & ~F.exists("_base", lambda b: (s["start"] < b["end"]) & (s["end"] > b["start"])),
    )
    return rows.withColumn("secret_spans", F.array_sort(F.concat("_base", markov))).drop(
        "_assign", "_access", "_hex", "_ratios", "_base"
    )


def spans_text(spans: Column) -> Column:
    """``kind:start:end`` of every span, joined by commas."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def redacted(documents: DataFrame, model: Model, text: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """``documents`` with every secret replaced by ``mark``; spans that overlap are replaced once. Null stays null.

    ``n_chars``, where there is such a column, becomes the length of the new text.
    """
    spans = with_spans(documents, model, text)
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    folded = F.aggregate(
        "secret_spans",
        start,
        lambda a, s: F.when(
            s["start"] >= a["at"],
            F.struct(s["end"].alias("at"), F.concat(a["out"], F.substring(text, a["at"] + 1, s["start"] - a["at"]), F.lit(mark)).alias("out")),
        ).otherwise(F.struct(F.greatest(a["at"], s["end"]).alias("at"), a["out"].alias("out"))),
        lambda a: F.concat(a["out"], F.substring(text, a["at"] + 1, F.length(text))),
    )
    out = spans.withColumn(text, F.when(F.size("secret_spans") > 0, folded).otherwise(F.col(text)))
    if "n_chars" in documents.columns:
        out = out.withColumn("n_chars", F.when(F.size("secret_spans") > 0, F.length(text).cast("long")).otherwise(F.col("n_chars")))
    return out.select(*documents.columns)
