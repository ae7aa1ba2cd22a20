"""Quality rules by cross-document line frequency (DataFrame functions only).

Per document: word and symbol counts, repeated lines, words in repeated
windows.  Across documents: normalised lines are hashed, distinct documents
are counted per (host, line), lines above the limits are removed, and
documents that lose too much of themselves are rejected.

Defined results: a null text has no words and fails the base rule; a null
host is a host of its own; repeated rows are judged alike, and equal texts
count once in a line's frequency (a group of copies does not reject itself);
an empty table gives an empty result; other columns of the input are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paylens.llm.common import BLANKS, boxed, same, saved, unboxed, words

SYMBOLS = "#*$%&|<>"
WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30


def repeated_window_words(window_hashes: Column, width: int = WINDOW) -> Column:
    """Words covered by windows whose hash occurs twice or more in the array."""
    ordered = F.sort_array(F.transform(window_hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def twice(pairs: Column) -> Column:
        return F.filter(pairs, lambda p, j: F.coalesce(p["h"] == F.get(pairs, j - 1)["h"], F.lit(False))
                        | F.coalesce(p["h"] == F.get(pairs, j + 1)["h"], F.lit(False)))

    def covered(starts: Column) -> Column:
        steps = F.transform(starts, lambda s, j: F.least(F.lit(width),
                                                         F.coalesce(F.get(starts, j + 1) - s, F.lit(width))))
        return F.aggregate(steps, F.lit(0), lambda a, b: a + b)

    # a one-element array binds an intermediate value, so that it is computed once
    pairs = F.transform(F.array(ordered), twice)
    starts = F.transform(pairs, lambda p: F.sort_array(F.transform(p, lambda x: x["i"])))
    total = F.get(F.transform(starts, covered), F.lit(0))
    return F.when(F.size(F.array_distinct(window_hashes)) == F.size(window_hashes), F.lit(0)).otherwise(total)


def document_stats(docs: DataFrame) -> DataFrame:
    """doc_id, host, content (hash of the text), the counts, ``base_failed`` and
    ``lines``: hash and words of each line that has a word."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", F.col("source").alias("host"), F.xxhash64("text").alias("content"),
                       text.alias("text"))
    rows = rows.select("doc_id", "host", "content",
                       (F.length("text") - F.length(F.translate("text", SYMBOLS, ""))).cast("long").alias("n_symbols"),
                       F.length(F.translate("text", BLANKS, "")).cast("long").alias("word_chars"),
                       F.filter(F.split("text", "\n"), lambda x: F.translate(x, BLANKS, "") != "").alias("kept_lines"))
    rows = rows.withColumns({
        "line_words": F.transform("kept_lines", words),
        "n_dup_lines": (F.size("kept_lines") - F.size(F.array_distinct("kept_lines"))).cast("long"),
    }).drop("kept_lines")
    rows = rows.withColumns({
        "words": F.flatten("line_words"),
        "lines": F.transform("line_words", lambda w: F.struct(F.xxhash64(F.lower(F.array_join(w, " "))).alias("hash"),
                                                              F.size(w).alias("words"))),
    }).drop("line_words")
    rows = rows.withColumns({
        "n_words": F.size("words").cast("long"),
        "windows": F.when(F.size("words") < WINDOW, F.array().cast("array<bigint>")).otherwise(
            F.transform(F.sequence(F.lit(1), F.greatest(F.size("words") - WINDOW + 1, F.lit(1))),
                        lambda i: F.xxhash64(F.slice("words", i, WINDOW)))),
    }).drop("words")
    rows = rows.withColumn("n_repeat_words", repeated_window_words(F.col("windows")).cast("long")).drop("windows")
    return rows.withColumn("base_failed", (F.col("n_words") < MIN_WORDS)
                           | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")))


def frequent_lines(stats: DataFrame, min_documents: int = 10, max_percent: int = 10) -> DataFrame:
    """(host, hash) of lines in ``min_documents`` or more distinct documents of a
    host and in over ``max_percent`` per cent of them."""
    texts = stats.select("host", "content").distinct().groupBy("host").agg(F.count("*").alias("texts"))
    seen = (stats.select("host", "content", F.explode("lines").alias("line"))
            .select("host", "content", F.col("line.hash").alias("hash")).distinct()
            .groupBy("host", "hash").agg(F.count("*").alias("n"))
            .filter(F.col("n") >= min_documents))
    return (seen.join(texts, same(seen, texts, ["host"]))
            .filter(100 * F.col("n") > max_percent * F.col("texts"))
            .select(seen["host"], "hash"))


def judged(docs: DataFrame, min_documents: int = 10, max_percent: int = 10,
           min_left_percent: int = 50) -> tuple[DataFrame, DataFrame]:
    """One row per document with its counts and ``kept``; and the frequent lines.

    A document is depleted if under ``min_left_percent`` per cent of its words
    are left without its frequent lines.
    """
    stats = saved(document_stats(docs).withColumn("row", F.monotonically_increasing_id()), "quality")
    frequent = saved(frequent_lines(stats, min_documents, max_percent), "frequent")
    lines = (stats.filter(~F.col("base_failed")).select("row", "host", F.explode("lines").alias("line"))
             .select("row", "host", F.col("line.hash").alias("hash"), F.col("line.words").alias("words")))
    lost = (lines.join(frequent, same(lines, frequent, ["host", "hash"]), "left_semi")
            .groupBy(F.col("row").alias("lost_row")).agg(F.sum("words").alias("n_removed")))
    out = stats.drop("lines").join(lost, F.col("row") == F.col("lost_row"), "left").drop("lost_row", "row")
    out = out.withColumn("n_removed", F.coalesce(F.col("n_removed"), F.lit(0)).cast("long"))
    left = 100 * (F.col("n_words") - F.col("n_removed"))
    return out.withColumn("kept", ~F.col("base_failed") & (left >= min_left_percent * F.col("n_words"))), frequent


def quality_rules(docs: DataFrame, **limits) -> DataFrame:
    """The verdict on every document (see :func:`judged`)."""
    return judged(docs, **limits)[0].select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "n_removed")


def apply_quality_rules(docs: DataFrame, **limits) -> DataFrame:
    """The kept documents, in their own columns, without the lines above the
    limits (``n_chars`` follows the text).  Rejected documents go."""
    verdicts, frequent = judged(docs, **limits)
    columns = docs.columns
    by_host = frequent.groupBy("host").agg(F.collect_set("hash").alias("_frequent"))
    lost = (verdicts.filter("kept").filter("n_removed > 0").select("doc_id", "host", "content").distinct()
            .alias("v").join(by_host.alias("b"), F.col("v.host").eqNullSafe(F.col("b.host")))
            .select(F.col("v.doc_id").alias("_id"), F.col("v.host").alias("_host"), "content", "_frequent"))
    out = verdicts.filter(~F.col("kept")).select(F.col("doc_id").alias("_id"), F.col("host").alias("_host"), "content",
                                                 F.lit(None).cast("array<bigint>").alias("_frequent")).distinct()
    marks = lost.unionByName(out).withColumn("_marked", F.lit(True))
    rows = boxed(docs, F.xxhash64("text").alias("hash"), F.col("doc_id"), F.col("source"), F.col("text"))
    rows = rows.join(marks, (F.col("hash") == F.col("content")) & F.col("doc_id").eqNullSafe(F.col("_id"))
                     & F.col("source").eqNullSafe(F.col("_host")), "left")
    rows = rows.filter(F.col("_marked").isNull() | F.col("_frequent").isNotNull())
    left = F.array_join(F.filter(F.split("text", "\n"), lambda x: (F.translate(x, BLANKS, "") == "")
                                 | ~F.array_contains("_frequent", F.xxhash64(F.lower(F.array_join(words(x), " "))))), "\n")
    return unboxed(rows, columns, left, F.coalesce("_marked", F.lit(False)))
