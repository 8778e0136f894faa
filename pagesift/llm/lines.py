"""Repeated runs of lines: winnowed windows as fingerprints, joined to their first place. JVM operators only.

A run of lines counts when it holds at least ``min_words`` words. For every line the shortest window of that many words
that starts there, and the one that ends there, is looked at; winnowing selects the first line with the smallest hash of each, and only
selected lines are fingerprints. Two equal runs have equal windows and so select equal lines: no common run of ``min_words``
words is missed. Places are joined on the fingerprints that occur at two places or more, and a match is extended from
there to both sides by the windows around it, each compared whole by a hash of its lines. A window that
occurs at an earlier place is a repetition, and all its lines go: a run is as long as its windows reach both ways. The
first place stays: the lowest ``doc_id``, then the hash of the text, then the position.

A line that a third of all documents share costs one row per task: whether a fingerprint occurs twice, and which place of a
window is the first, are minima taken map-side; no pairs of places are made. A plain join of a fingerprint with its first
place would miss runs, as a line's first place need not be that of the run.

Defined results: lines are compared without blanks around them; empty lines are no lines of a run; those behind
a line that goes do so with it. Null texts
stay null. Rows that agree in ``doc_id`` and text are one document and are treated alike. A run that repeats itself
within a document is cut down to its first period. Documents without ``doc_id`` come last.

Whole lines miss a passage in mid-line and a line edited in one word. ``without_passages`` looks at words, whatever the
lines: each run of ``PASSAGE`` words that occurs at an earlier place goes. Winnowing (the smallest word hash of every
window of ``WINDOW`` words, with a hash of the ``PRINT`` words from there) finds the places that can share such a run,
as any run holds a whole window and its print; around the prints that occur twice every run of ``PASSAGE`` words is
compared by its hash. A line break that ends a passage stays.

Most documents repeat nothing: only those that may do so, told by a bitmap of their keys, are shuffled to meet what was found.
Tables of one step go before the next one shuffles texts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagesift.llm.common import drop, met_and_others, release, scratch, stored

MIN_WORDS = 8
PASSAGE, WINDOW, PRINT = 51, 36, 16  # words; a run of PASSAGE words holds WINDOW places at which PRINT words begin
POSITION = 2**31  # places of words in a packed number: more than an array can hold
BLANKS = " \t\n\x0b\f\r"
LAST_ID = 2**63 - 1


def _words(line: Column) -> Column:
    return F.length(line) - F.length(F.replace(line, F.lit(" "), F.lit(""))) + 1


def _lines(text: Column) -> Column:
    """(pos, hash, words, till) of the lines that are not empty; ``till`` is the last empty line behind a line."""
    all_lines = F.transform(
        F.split(text, "\n"),
        lambda line, k: F.struct(k.alias("pos"), F.xxhash64(F.trim(line)).alias("hash"), _words(F.trim(line)).alias("words"), (F.trim(line) != "").alias("full")),
    )
    full = F.filter(all_lines, lambda s: s["full"])
    after = F.concat(F.slice(F.transform(full, lambda s: s["pos"]), 2, F.size(full)), F.array(F.size(all_lines)))
    return F.zip_with(full, after, lambda s, n: F.struct(s["pos"], s["hash"], s["words"], (n - 1).alias("till")))


def _window(lines: Column, least: int) -> Column:
    """From the given lines, in order: how many are needed for ``least`` words; null if they do not have so many."""
    start = F.struct(F.lit(0).alias("words"), F.lit(0).alias("n"))
    return F.aggregate(
        lines,
        start,
        lambda a, x: F.when(a["words"] >= least, a).otherwise(
            F.struct((a["words"] + x["words"]).cast("int").alias("words"), (a["n"] + 1).alias("n"))
        ),
        lambda a: F.when(a["words"] >= least, a["n"]),
    )


def _selected(lines: Column) -> Column:
    """A window with the line that winnowing selects in it: the first one with the smallest hash."""
    content = F.aggregate(lines, F.lit(0).cast("long"), lambda h, x: F.xxhash64(h, x["hash"]))
    least = F.array_min(F.transform(lines, lambda x: F.struct(x["hash"], x["pos"])))
    return F.struct(
        least["hash"].alias("least"),
        least["pos"].alias("at"),
        content.alias("content"),
        F.get(lines, F.lit(0))["pos"].alias("start"),
        F.element_at(lines, -1)["till"].alias("end"),
    )


def _windows(lines: Column, least: int) -> Column:
    """The windows that start and that end at each line; at most ``least`` lines make a window."""
    places = F.sequence(F.lit(1), F.size(lines))

    def forward(i: Column) -> Column:
        n = _window(F.slice(lines, i, least), least)
        return F.when(n.isNotNull(), _selected(F.slice(lines, i, F.coalesce(n, F.lit(1)))))

    def backward(i: Column) -> Column:
        first = F.greatest(i - (least - 1), F.lit(1))
        n = _window(F.reverse(F.slice(lines, first, i - first + 1)), least)
        # a window of one line has been found forwards already
        return F.when(n > 1, _selected(F.slice(lines, i - F.coalesce(n, F.lit(1)) + 1, F.coalesce(n, F.lit(1)))))

    found = F.when(F.size(lines) > 0, F.concat(F.transform(places, forward), F.transform(places, backward)))
    return F.array_distinct(F.filter(F.coalesce(found, F.array()), lambda w: w.isNotNull()))


def repeated_spans(documents: DataFrame, text: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """``_doc, _hash, spans``: first and last line (from 0) of every window that occurs at an earlier place."""
    rows = documents.where(F.length(text) > 0).select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST_ID)).alias("_doc"), F.xxhash64(text).alias("_hash"), _lines(F.col(text)).alias("_lines")
    )
    spark = documents.sparkSession
    with scratch(spark, "windows") as folder:
        windows = stored(rows.select("_doc", "_hash", F.inline(_windows(F.col("_lines"), min_words))), "line-windows")
    # matches: the windows around selected lines that are at two places or more, told apart by all their lines
    place = F.struct("_doc", "_hash", "start", "end")
    around = windows.join(_shared(windows, "least", "at"), "least").drop("at")
    first = around.groupBy("least", "content").agg(F.min(place).alias("first"), F.max(place).alias("last"))
    first = first.where("first <> last").select("least", "content", "first")
    later = around.join(first, ["least", "content"]).where(place > F.col("first"))
    spans = stored(later.groupBy("_doc", "_hash").agg(F.collect_set(F.struct("start", "end")).alias("spans")), "line-spans")
    del windows, around, first, later
    drop(spark, folder)  # and what Spark holds for it, before the texts are joined
    return spans


def without_repeats(documents: DataFrame, text: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """``documents`` without the lines of later repetitions, and with ``n_lines`` and ``n_removed`` of each row.

    ``n_chars``, where there is such a column, becomes the length of a text that has changed.
    """
    keys = {
        "_doc": F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST_ID)),
        "_hash": F.xxhash64(F.coalesce(F.col(text), F.lit(""))),
    }
    spans = repeated_spans(documents, text, min_words)
    met, others = met_and_others(documents.withColumns(keys), spans, ["_doc", "_hash"])
    lines = F.split(text, "\n")
    # the stretches between the spans, from the spans in order
    stretches = F.aggregate(
        F.array_sort(F.col("spans")),
        F.struct(F.lit(0).alias("upto"), F.array().cast("array<struct<a:int,b:int>>").alias("keep")),
        lambda acc, s: F.struct(
            F.greatest(acc["upto"], s["end"] + 1).alias("upto"),
            F.when(
                s["start"] > acc["upto"],
                F.concat(acc["keep"], F.array(F.struct(acc["upto"].alias("a"), s["start"].alias("b")))),
            )
            .otherwise(acc["keep"])
            .alias("keep"),
        ),
        lambda acc: F.concat(acc["keep"], F.array(F.struct(acc["upto"].alias("a"), F.lit(2**31 - 1).alias("b")))),
    )
    n = F.size("_all")
    kept = F.flatten(F.transform("_keep", lambda s: F.slice("_all", s["a"] + 1, F.greatest(F.least(s["b"], n) - s["a"], F.lit(0)))))
    out = met.join(spans, ["_doc", "_hash"], "left").withColumns({"_all": lines, "_keep": F.when(F.col("spans").isNotNull(), stretches)})
    out = out.withColumn("_left", F.when(F.col("_keep").isNotNull(), kept))
    changed = F.col("_left").isNotNull()
    new = {
        text: F.when(changed, F.array_join("_left", "\n")).otherwise(F.col(text)),
        "n_lines": F.when(F.col(text).isNull(), 0).otherwise(F.size("_all")),
        "n_removed": F.when(changed, F.size("_all") - F.size("_left")).otherwise(0),
    }
    out = out.withColumns(new)
    if "n_chars" in documents.columns:
        out = out.withColumn("n_chars", F.when(F.col("n_removed") > 0, F.length(text).cast("long")).otherwise(F.col("n_chars")))
    as_before = others.withColumns({"n_lines": F.when(F.col(text).isNull(), 0).otherwise(F.size(lines)), "n_removed": F.lit(0)})
    return out.select(*documents.columns, "n_lines", "n_removed").unionByName(as_before.select(*documents.columns, "n_lines", "n_removed"))


def _pieces(text: Column) -> Column:
    """Words with the white space behind them; joined they are the text again."""
    return F.split(text, r"(?<=\s)(?=\S)")


def _prints(words: Column) -> Column:
    """(print, at) of the places that winnowing selects: the first of the smallest word hashes of every window."""
    packed = F.transform(words, lambda h, i: h.bitwiseAND(F.lit(-POSITION)).bitwiseOR(i.cast("long")))
    windows = F.transform(F.array(packed), lambda p: F.transform(
        F.sequence(F.lit(1), F.size(p) - (WINDOW + PRINT - 2)), lambda i: F.array_min(F.slice(p, i, WINDOW))
    ))
    places = F.transform(F.array_distinct(F.get(windows, F.lit(0))), lambda m: m.bitwiseAND(F.lit(POSITION - 1)).cast("int"))
    return F.transform(places, lambda k: F.struct(F.xxhash64(F.slice(words, k + 1, PRINT)).alias("print"), k.alias("at")))


def _runs(words: Column, places: Column) -> Column:
    """(run, at) of every run of PASSAGE words around the prints at ``places``."""
    starts = F.flatten(F.transform(places, lambda k: F.sequence(
        F.greatest(k - (PASSAGE - PRINT), F.lit(0)), F.greatest(F.least(k, F.size(words) - PASSAGE), F.lit(0))
    )))
    return F.transform(F.array_distinct(starts), lambda k: F.struct(F.xxhash64(F.slice(words, k + 1, PASSAGE)).alias("run"), k.alias("at")))


def _shared(places: DataFrame, key: str, name: str) -> DataFrame:
    """The values of ``key`` that occur at more than one place, places told apart by a hash."""
    ends = places.select(key, F.xxhash64("_doc", "_hash", name).alias("place")).groupBy(key).agg(F.min("place").alias("low"), F.max("place").alias("high"))
    return ends.where("low <> high").select(key)


def without_passages(documents: DataFrame, text: str = "text") -> DataFrame:
    """``documents`` without later repetitions of runs of ``PASSAGE`` words or more, and with ``n_words_removed``.

    ``n_chars``, where there is such a column, becomes the length of a text that has changed.
    """
    keys = {
        "_doc": F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST_ID)),
        "_hash": F.xxhash64(F.coalesce(F.col(text), F.lit(""))),
    }
    spark = documents.sparkSession
    hashes = F.transform("_pieces", lambda p: F.xxhash64(F.btrim(p, F.lit(BLANKS))))
    rows = documents.withColumns(keys).select("_doc", "_hash", _pieces(F.col(text)).alias("_pieces")).where(F.size("_pieces") >= PASSAGE)
    with scratch(spark, "prints") as folder:
        prints = stored(rows.select("_doc", "_hash", hashes.alias("_words")).select("_doc", "_hash", F.inline(_prints(F.col("_words")))), "word-prints")
    shared = prints.join(_shared(prints, "print", "at"), "print").groupBy("_doc", "_hash").agg(F.collect_set("at").alias("_places"))
    shared = stored(shared, "print-places")
    del prints
    drop(spark, folder)  # before the texts' words are shuffled
    with scratch(spark, "runs") as folder:
        met, _ = met_and_others(rows, shared, ["_doc", "_hash"])
        runs = met.select("_doc", "_hash", hashes.alias("_words")).join(shared, ["_doc", "_hash"])
        runs = stored(runs.select("_doc", "_hash", F.inline(_runs(F.col("_words"), F.col("_places")))), "word-runs")
        place = F.struct("_doc", "_hash", "at")
        first = runs.groupBy("run").agg(F.min(place).alias("first"), F.max(place).alias("last")).where("first <> last").select("run", "first")
        first = stored(first, "first-runs")  # read again, so that the join may split the rows of a run that very many have
    release(spark)
    later = runs.join(first, "run").where(place > F.col("first"))
    starts = stored(later.groupBy("_doc", "_hash").agg(F.array_sort(F.collect_set("at")).alias("_starts")), "later-runs")
    del runs, first, later
    drop(spark, folder)
    # the stretches that stay, and behind each passage its line break
    none = F.array().cast("array<struct<a:int,b:int>>")
    stretches = F.aggregate(
        "_starts",
        F.struct(F.lit(0).alias("upto"), none.alias("keep")),
        lambda acc, s: F.struct(
            (s + PASSAGE).alias("upto"),
            F.when((s > acc["upto"]) | (acc["upto"] == 0), F.concat(acc["keep"], F.array(F.struct(acc["upto"].alias("a"), s.alias("b")))))
            .otherwise(acc["keep"])
            .alias("keep"),
        ),
        lambda acc: F.concat(acc["keep"], F.array(F.struct(acc["upto"].alias("a"), F.size("_pieces").alias("b")))),
    )

    def part(s: Column) -> Column:
        broken = (s["a"] > 0) & F.get("_pieces", s["a"] - 1).contains("\n")
        return F.concat(F.when(broken, "\n").otherwise(""), F.array_join(F.slice("_pieces", s["a"] + 1, s["b"] - s["a"]), ""))

    met, others = met_and_others(documents.withColumns(keys), starts, ["_doc", "_hash"])
    out = met.join(starts, ["_doc", "_hash"], "left")
    out = out.withColumn("_pieces", F.when(F.col("_starts").isNotNull(), _pieces(F.col(text))))
    out = out.withColumn("_keep", F.when(F.col("_starts").isNotNull(), stretches))
    changed = F.col("_keep").isNotNull()
    kept = F.aggregate("_keep", F.lit(0), lambda n, s: n + s["b"] - s["a"])
    new = {
        text: F.when(changed, F.array_join(F.transform("_keep", part), "")).otherwise(F.col(text)),
        "n_words_removed": F.when(changed, F.size("_pieces") - kept).otherwise(0),
    }
    out = out.withColumns(new)
    if "n_chars" in documents.columns:
        out = out.withColumn("n_chars", F.when(F.col("n_words_removed") > 0, F.length(text).cast("long")).otherwise(F.col("n_chars")))
    as_before = others.withColumn("n_words_removed", F.lit(0)).select(*documents.columns, "n_words_removed")
    return out.select(*documents.columns, "n_words_removed").unionByName(as_before)
