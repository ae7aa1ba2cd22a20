"""Line dedup by winnowing over line hashes.

The lines that have a word, lower-cased (A-Z) and with blanks collapsed, are
hashed.  A run of lines is long if it has ``width`` lines, or ``words`` words.
Of every window (``width`` consecutive lines, or fewer that have ``words``
words) the least hash is selected (the last of equal ones).  Equal windows
select equal lines, so any two places that share a long run share a
fingerprint in it: no other line is written.

Positions are joined on shared fingerprints.  A match is extended from its
fingerprint line by line, both ways, up to the windows that selected it; their
neighbours' fingerprints carry it on, and touching matches are one run.  What
is deleted is thereby, of every document, each maximal run that it has in
common with an earlier place (by doc_id, then position) and that is long, with
the blank lines inside it.  A document without any window (under ``width``
lines and under ``words`` words) is one match by itself: all of it goes if an
earlier document has the same lines and no others.

Positions of a fingerprint are never paired with each other: an extended match
is compared with the first place that has it, found by an aggregation that
combines map-side.

Defined results: a null or empty text has no lines; a null doc_id comes after
all others; rows with equal doc_id and text are judged alike, and are no
earlier than each other; an empty table gives an empty result; other columns
are carried or ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from paylens.llm.common import BLANKS, boxed, mixed, rows_of, saved, sliding_hashes, temporary, unboxed

WIDTH = 3
WORDS = 50
# Whole documents are scanned together up to about this many lines.
LINES_AT_ONCE = 1 << 15
WHOLE = np.uint64(0xD6E8FEB86659FD93)
MATCH = pa.struct([("match", pa.int64()), ("start", pa.int32()), ("end", pa.int32()),
                   ("first", pa.int32()), ("last", pa.int32())])


def selected(h: np.ndarray, width: int) -> np.ndarray:
    """For each window of ``width`` hashes, the position of its least (last of equal ones)."""
    windows = np.lib.stride_tricks.sliding_window_view(h, width)[:, ::-1]
    return np.arange(len(windows)) + width - 1 - windows.argmin(axis=1)


def windows(h: np.ndarray, sizes: np.ndarray, doc: np.ndarray, width: int, words: int) -> tuple[np.ndarray, ...]:
    """Hash, start, end and selected line of every window of the lines (hashes
    ``h`` with ``sizes`` words) of documents that follow each other (``doc``:
    the number of each line's document), ordered by selected line."""
    total = np.concatenate([[0], np.cumsum(sizes)])
    lines = np.bincount(doc)
    begin = np.cumsum(lines) - lines
    windowless = lines < width
    parts = []
    for k in range(1, min(width, len(h)) + 1):
        start = np.arange(len(h) - k + 1)
        keep = doc[start] == doc[start + k - 1]
        if k < width:
            keep &= total[k:][start] - total[start] >= words
        start = start[keep]
        windowless[doc[start]] = False
        parts.append((sliding_hashes(h, k)[start], start, start + k - 1, selected(h, k)[start]))
    for k in range(1, min(width - 1, len(h)) + 1):
        start = begin[windowless & (lines == k)]
        parts.append((mixed(sliding_hashes(h, k)[start] ^ WHOLE), start, start + k - 1, selected(h, k)[start]))
    keys, start, end, least = (np.concatenate(p) for p in zip(*parts, strict=True))
    order = np.lexsort((end, start, least))
    return keys[order], start[order], end[order], least[order]


def fingerprints_of(docs: DataFrame, width: int = WIDTH, words: int = WORDS) -> DataFrame:
    """One row per selected line: doc_id, content (hash of the text), fingerprint,
    and ``matches``: the windows that selected it (hash, positions of their
    start and end, and the raw line numbers of both)."""

    def rows(hashes: list, sizes: list[int], raw: list[int], doc: list[int], ids: list, contents: list) -> pa.RecordBatch:
        h, number, line = np.array(hashes, np.uint64), np.array(doc), np.array(raw)
        keys, start, end, least = windows(h, np.array(sizes), number, width, words)
        at, offsets = np.unique(least, return_index=True)
        before = np.searchsorted(number, number[start])
        matches = pa.StructArray.from_arrays(
            [pa.array(keys.view(np.int64)),
             *(pa.array(v, pa.int32()) for v in (start - before, end - before, line[start], line[end]))], fields=list(MATCH))
        owner = pa.array(number[at])
        return pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()).take(owner), pa.array(contents, pa.int64()).take(owner),
             pa.array(h[at].view(np.int64)),
             pa.ListArray.from_arrays(pa.array(np.append(offsets, len(least)), pa.int32()), matches)],
            ["doc_id", "content", "fingerprint", "matches"])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh3_64_intdigest
        held: tuple[list, ...] = ([], [], [], [], [], [])
        for batch in batches:
            for doc_id, content, text in rows_of(batch):
                hashes, sizes, raw, doc, ids, contents = held
                before = len(hashes)
                for k, line in enumerate((text or b"").lower().split(b"\n")):
                    cut = line.split()
                    if cut:
                        hashes.append(digest(b" ".join(cut)))
                        sizes.append(len(cut))
                        raw.append(k)
                if len(hashes) == before:
                    continue
                doc += [len(ids)] * (len(hashes) - before)
                ids.append(doc_id)
                contents.append(content)
                if len(hashes) >= LINES_AT_ONCE:
                    yield rows(*held)
                    held = ([], [], [], [], [], [])
        if held[0]:
            yield rows(*held)

    return docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("content"),
                       F.col("text").cast("binary")).mapInArrow(
        scan, "doc_id long, content long, fingerprint long, "
              "matches array<struct<match: long, start: int, end: int, first: int, last: int>>")


def repeated_runs(docs: DataFrame, width: int = WIDTH, words: int = WORDS) -> DataFrame:
    """doc_id, content, runs: (first, last) raw lines of every run to delete."""
    prints = saved(fingerprints_of(docs, width, words), "prints")
    shared = prints.groupBy("fingerprint").agg(F.count("*").alias("n")).filter("n > 1").select("fingerprint")
    at = prints.join(shared, "fingerprint", "left_semi").select("doc_id", "content", F.inline("matches"))
    # a null doc_id sorts after the others
    place = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id"), F.col("start"))
    first = (at.groupBy("match").agg(F.min(place).alias("origin"), F.count("*").alias("n")).filter("n > 1")
             .select(F.col("match").alias("_match"), "origin"))
    later = at.join(first, F.col("match") == F.col("_match")).filter(place > F.col("origin"))
    order = Window.partitionBy("doc_id", "content").orderBy("start", "end")
    reached = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    touched = later.withColumn("new", (F.col("start") > F.coalesce(reached, F.lit(-2)) + 1).cast("int"))
    runs = (touched.withColumn("run", F.sum("new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
            .groupBy("doc_id", "content", "run").agg(F.min("first").alias("first"), F.max("last").alias("last")))
    return runs.groupBy(F.col("doc_id").alias("_id"), F.col("content").alias("_content")).agg(
        F.sort_array(F.collect_list(F.struct("first", "last"))).alias("_runs"))


def _without(text: Column, runs: Column) -> Column:
    """``text`` without its lines in ``runs``: the stretches between them, joined."""

    def between(lines: Column) -> Column:
        def stretch(k: Column) -> Column:
            start = F.when(k == 0, F.lit(0)).otherwise(F.get(runs, k - 1)["last"] + 1)
            end = F.coalesce(F.get(runs, k)["first"], F.size(lines))
            return F.slice(lines, start + 1, end - start)

        return F.array_join(F.flatten(F.transform(F.sequence(F.lit(0), F.size(runs)), stretch)), "\n")

    # the lines are cut once: a lambda's variable, not an expression in each stretch
    return F.transform(F.array(F.split(text, "\n")), between)[0]


def deduplicated(docs: DataFrame, width: int = WIDTH, words: int = WORDS) -> DataFrame:
    """doc, doc_id, text, ``left`` (the text without its later repeated runs)
    and ``touched`` (whether any line went) of every document."""
    with temporary(docs.sparkSession):
        runs = saved(repeated_runs(docs, width, words), "runs", keep=True)
    rows = boxed(docs, F.xxhash64("text").alias("hash"), F.col("doc_id"), F.col("text"))
    # the same plan at every size: texts meet their runs by a merge join
    rows = rows.join(runs.hint("merge"), (F.col("hash") == F.col("_content")) & F.col("doc_id").eqNullSafe(F.col("_id")), "left")
    touched = F.col("_runs").isNotNull()
    return rows.select("doc", "doc_id", "text",
                       F.when(touched, _without(F.col("text"), F.col("_runs"))).otherwise(F.col("text")).alias("left"),
                       touched.alias("touched"))


def _lines(text: Column) -> Column:
    kept = F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda x: F.translate(x, BLANKS, "") != "")
    return F.size(kept).cast("long")


def line_dedup(docs: DataFrame, width: int = WIDTH, words: int = WORDS) -> DataFrame:
    """doc_id, n_lines (that have a word), n_removed of them, and the SHA-256 of
    the text that is left (UTF-8; of an empty text for null)."""
    rows = deduplicated(docs.select("doc_id", "text"), width, words)
    return rows.select("doc_id", _lines(F.col("text")).alias("n_lines"),
                       (_lines(F.col("text")) - _lines(F.col("left"))).alias("n_removed"),
                       F.sha2(F.coalesce(F.col("left"), F.lit("")), 256).alias("kept_sha256"))


def apply_line_dedup(docs: DataFrame, width: int = WIDTH, words: int = WORDS) -> DataFrame:
    """The documents without their later repeated runs, in their own columns
    (``n_chars`` follows the text).  A document of which every line with a word
    was deleted goes: all of it stands in earlier documents."""
    rows = deduplicated(docs, width, words).filter(~F.col("touched") | (F.translate("left", BLANKS, "") != ""))
    return unboxed(rows, docs.columns, F.col("left"), F.col("touched"))
