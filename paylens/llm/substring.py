"""Substring dedup by suffix automata of reference shards.

A word goes if a window of ``WINDOW`` consecutive words covers it whose word
sequence also starts in a document with a smaller doc_id.

Reference text of the whole corpus cannot be broadcast, nor can every document
be streamed past all of it.  So the shards are cut by content:

1. Every window selects the least hash among its ``GRAM``-word runs: its
   anchor.  Equal windows select equal anchors.  Anchors that only one document
   has are dropped; the others say which documents must meet.
2. Consecutive windows of one anchor are a segment.  All segments of an anchor
   are a shard.  It is read in doc_id order: a segment seen before goes whole,
   a new one is streamed through the suffix automaton of the earlier ones, and
   where the match reaches ``WINDOW`` words, they go (matching statistics).
   Then it joins the automaton.
3. An anchor that over ``crowd`` documents share would make a large shard.  Its
   segments are compared as wholes first (by hash, 128 bits): one seen before
   goes whole, as in 2.  This leaves a segment per text, and most anchors with
   few: their shards are read as in 2.  If over ``crowd`` are left, the windows
   are shards of their own: equal by hash, they need the least doc_id only.
   Segments and windows are sorted by range, so no task gets all of one hash,
   and each is compared to the least doc_id as it passes.  What a task cannot
   settle, as an earlier one holds the same hash, is settled by the least
   doc_id of each hash that tasks begin with.

Windows are judged on the input.  Defined results: a null, empty or blank text
has no words and keeps the empty text's SHA-256; fewer than ``WINDOW`` words
lose nothing; rows that repeat a doc_id are no smaller than each other; a null
doc_id is greater than all others; an empty table gives an empty result; other
columns of the input are ignored.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paylens.llm.common import rows_of, saved, sliding_hashes, temporary, word_hashes

WINDOW = 13
GRAM = 4
CROWD = 1024
CHECK_SEED = 1
LAST = (1 << 63) - 1  # stands for a null doc_id


class Automaton:
    """Suffix automaton of word sequences (a state per set of end positions)."""

    def __init__(self) -> None:
        self.go: list[dict] = [{}]
        self.link, self.length = [-1], [0]

    def _state(self, length: int, go: dict, link: int) -> int:
        self.go.append(go)
        self.length.append(length)
        self.link.append(link)
        return len(self.go) - 1

    def _split(self, origin: int, word: bytes, to: int) -> int:
        """The state for ``origin`` + ``word`` alone, cut out of ``to`` if that holds longer runs."""
        if self.length[to] == self.length[origin] + 1:
            return to
        copy = self._state(self.length[origin] + 1, dict(self.go[to]), self.link[to])
        self.link[to] = copy
        while origin >= 0 and self.go[origin].get(word) == to:
            self.go[origin][word] = copy
            origin = self.link[origin]
        return copy

    def add(self, words: Iterable[bytes]) -> None:
        last = 0
        for word in words:
            known = self.go[last].get(word)
            if known is not None:
                last = self._split(last, word, known)
                continue
            new = self._state(self.length[last] + 1, {}, 0)
            at = last
            while at >= 0 and word not in self.go[at]:
                self.go[at][word] = new
                at = self.link[at]
            if at >= 0:
                self.link[new] = self._split(at, word, self.go[at][word])
            last = new

    def matches(self, words: Iterable[bytes]) -> Iterator[int]:
        """After each word: the length of the longest run ending there that was added."""
        at, length = 0, 0
        for word in words:
            while at > 0 and word not in self.go[at]:
                at = self.link[at]
                length = self.length[at]
            if word in self.go[at]:
                at = self.go[at][word]
                length += 1
            yield length


def anchors_of(words: list[bytes], window: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the words; of their runs; and each window's anchor position."""
    h = word_hashes(words)
    runs = sliding_hashes(h, gram)
    if len(words) < window:
        return h, runs, np.empty(0, dtype=np.int64)
    spans = np.lib.stride_tricks.sliding_window_view(runs, window - gram + 1)
    return h, runs, spans.argmin(axis=1) + np.arange(len(spans))


def anchor_values(runs: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The hash of each window's anchor, an even long: its last bit is free for a mark."""
    return runs[at].view(np.int64) & ~1


def window_hashes(words: list[bytes], h: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Two independent hashes of each window: of the words' hashes, and of others by another seed."""
    return sliding_hashes(h, window), sliding_hashes(word_hashes(words, CHECK_SEED), window)


def text_hash(text: bytes) -> tuple[int, int]:
    """128 bits of a text's hash, as two (signed) longs."""
    return struct.unpack("<qq", xxhash.xxh3_128_digest(text))


def listed_anchors(rows: DataFrame, window: int, gram: int, crowd: int) -> DataFrame:
    """Per document: d and its ``rare`` anchors, and ``often`` those in over
    ``crowd`` documents of the batch; a row without d lists the latter again."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        longs = pa.list_(pa.int64())
        for batch in batches:
            sets = []
            for text in batch.column(1):
                _, runs, at = anchors_of((text.as_py() or b"").split(), window, gram)
                sets.append(np.unique(anchor_values(runs, at)))
            values, counts = np.unique(np.concatenate(sets), return_counts=True) if sets else (np.empty(0, np.int64),) * 2
            often = values[counts > crowd]
            hot = [np.isin(s, often, kind="sort") for s in sets]
            ids = pa.concat_arrays([batch.column(0), pa.nulls(1, pa.int64())])
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array([s[~k] for s, k in zip(sets, hot, strict=True)] + [often], longs),
                 pa.array([s[k] for s, k in zip(sets, hot, strict=True)] + [[]], longs)], ["d", "rare", "often"])

    return rows.select("d", "text").mapInArrow(scan, "d long, rare array<long>, often array<long>")


def shared_anchors(table: DataFrame, crowd: int) -> DataFrame:
    """d, anchors: those in two or more documents, their last bit set if crowded."""
    listed = table.select(F.explode("rare").alias("anchor"), "d").repartition("anchor")
    counts = (listed.groupBy("anchor").agg(F.count("*").alias("rows"), F.min("d").alias("low"), F.max("d").alias("high"),
                                           F.max(F.col("d").isNull()).alias("marked"))
              .filter("marked or low < high")
              .select("anchor", (F.col("marked") | (F.col("rows") > crowd)).alias("crowded")))
    shared = listed.join(counts, "anchor").filter("d is not null")
    hot = table.filter("d is not null").select(F.explode("often").alias("anchor"), "d", F.lit(True).alias("crowded"))
    marked = shared.select("anchor", "d", "crowded").unionByName(hot).select(
        F.col("d").alias("_d"), (F.col("anchor") + F.col("crowded").cast("long")).alias("anchor"))
    return marked.groupBy("_d").agg(F.collect_list("anchor").alias("anchors"))


def compact(rows: DataFrame) -> DataFrame:
    """``rows`` with compressed texts (``zipped``): whole texts are shuffled twice."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            texts = pa.array([press.compress(t.as_py() or b"") for t in batch.column("text")], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], texts], [*batch.schema.names[:3], "zipped"])

    return rows.select("doc_id", "d", "content", "text").mapInArrow(
        scan, "doc_id long, d long, content long, zipped binary")


def opened(zipped: pa.Scalar) -> list[bytes]:
    """The words of a compressed text."""
    return zstandard.decompress(zipped.as_py()).split()


def segments_of(rows: DataFrame, anchors: DataFrame, window: int, gram: int) -> DataFrame:
    """d, content, start, key, check, words and anchor of every segment of a
    shared anchor.  key is the anchor; if that is crowded, it stands in anchor,
    and key and check are the hash of the words."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["d", "content", "start", "key", "check", "words", "anchor"]
        kinds = [pa.int64()] * 5 + [pa.binary(), pa.int64()]
        for batch in batches:
            out: list[list] = [[] for _ in names]
            for d, content, zipped, marks in zip(*batch.columns, strict=True):
                words = opened(zipped)
                _, runs, at = anchors_of(words, window, gram)
                if not len(at):
                    continue
                known = np.sort(marks.values.to_numpy())
                known, crowded = known & ~1, (known & 1).astype(bool)
                value = anchor_values(runs, at)
                place = np.minimum(np.searchsorted(known, value), len(known) - 1)
                hit = known[place] == value
                # a segment starts where the anchor's position changes
                starts = np.flatnonzero(np.diff(at, prepend=-1))
                ends = np.append(starts[1:], len(at))
                shared = hit[starts]
                for a, b, alone in zip(*(c[shared].tolist() for c in (starts, ends, crowded[place[starts]])), strict=True):
                    part = b" ".join(words[a:b + window - 1])
                    anchor = int(value[a])
                    row = (*text_hash(part), part, anchor) if alone else (anchor, 0, part, None)
                    for column, item in zip(out, (d.as_py(), content.as_py(), a, *row), strict=True):
                        column.append(item)
                if len(out[0]) > 50_000:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, kinds, strict=True)], names)
                    out = [[] for _ in names]
            if out[0]:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, kinds, strict=True)], names)

    return rows.join(anchors, F.col("d") == F.col("_d")).select("d", "content", "zipped", "anchors").mapInArrow(
        scan, "d long, content long, start long, key long, check long, words binary, anchor long")


def shard_spans(segments: DataFrame, window: int) -> DataFrame:
    """d, content, first, end: words that go, found within the shards of anchors."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, d = None, None
        seen: dict[bytes, int] = {}  # segment: its first document
        automaton: Automaton | None = None
        waiting: list[bytes] = []  # new segments of this document
        for batch in batches:
            out: list[tuple] = []
            for new_key, new_d, content, start, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if new_key != key:
                    key, d, seen, automaton, waiting = new_key, None, {}, None, []
                if new_d != d:
                    if waiting and automaton is not None:
                        for part in waiting:
                            automaton.add(part.split())
                        waiting = []
                    d = new_d
                first = seen.get(text)
                if first is not None and first < new_d:
                    out.append((new_d, content, start, start + text.count(b" ") + 1))
                    continue
                words = text.split()
                earlier = [s for s, at in seen.items() if at < new_d] if automaton is None else None
                if earlier:
                    automaton = Automaton()
                    for part in earlier:
                        automaton.add(part.split())
                    waiting = [s for s, at in seen.items() if at >= new_d]
                if automaton is not None:
                    end = -1
                    for k, length in enumerate(automaton.matches(words)):
                        if length >= window:
                            if end < 0 or k - window + 1 > end:
                                if end >= 0:
                                    out.append((new_d, content, start + begin, start + end))
                                begin = k - window + 1
                            end = k + 1
                    if end >= 0:
                        out.append((new_d, content, start + begin, start + end))
                if first is None:
                    seen[text] = new_d
                    waiting.append(text)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)],
                                                 ["d", "content", "first", "end"])

    ordered = (segments.select("key", "d", "content", "start", "words")
               .repartition("key").sortWithinPartitions("key", "d"))
    return ordered.mapInArrow(scan, "d long, content long, first long, end long")


def compared_segments(segments: DataFrame) -> DataFrame:
    """Segments of crowded anchors: d, content, first, end of those whose text
    a smaller document has, they go whole; of the others also words, anchor,
    key and check, and ``open`` if they are of their task's first text.

    They are dealt by ranges of (key, check, d), so those of one text may take
    many tasks.  Each task leaves those of the least document that it saw: none
    of a smaller one is lost, only an earlier task may have seen a smaller one."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["d", "content", "first", "end", "words", "anchor", "key", "check", "open"]
        last, least, groups = None, np.int64(0), 0
        for batch in batches:
            if not batch.num_rows:
                continue
            key, check, d, content, start = (c.to_numpy() for c in batch.columns[:5])
            words, anchor = batch.columns[5:]
            new = np.ones(len(d), dtype=bool)
            new[1:] = (key[1:] != key[:-1]) | (check[1:] != check[:-1])
            new[0] = last != (key[0], check[0])
            number = groups + np.cumsum(new)
            at = np.maximum.accumulate(np.where(new, np.arange(len(d)), -1))
            low = np.where(at >= 0, d[at], least)
            gone = d > low
            size = pc.count_substring(words, b" ").to_numpy() + 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in (d, content, start, start + size)]
                + [pc.if_else(pa.array(gone), pa.scalar(None, c.type), c) for c in (words, anchor)]
                + [pa.array(c, mask=gone) for c in (key, check, number == 1)], names)
            last, least, groups = (key[-1], check[-1]), low[-1], number[-1]

    whole = segments.filter("anchor is not null").select("key", "check", "d", "content", "start", "words", "anchor")
    ordered = whole.repartitionByRange("key", "check", "d").sortWithinPartitions("key", "check", "d")
    return ordered.mapInArrow(scan, "d long, content long, first long, end long, words binary, anchor long, "
                                    "key long, check long, open boolean")


def crowded_segments(segments: DataFrame) -> DataFrame:
    """d, content, first, end, words and anchor of segments of crowded anchors:
    words and anchor only of those whose text no smaller document has."""
    whole = saved(compared_segments(segments), "whole")
    # a row per task at most
    texts = whole.filter("open").select("key", "check").distinct()
    least = (whole.filter("key is not null").select("key", "check", "d").join(F.broadcast(texts), ["key", "check"], "left_semi")
             .groupBy("key", "check").agg(F.min("d").alias("least")))
    settled = saved(whole.filter("open").join(F.broadcast(least), ["key", "check"]).select(
        "d", "content", "first", "end",
        *(F.when(F.col("d") <= F.col("least"), F.col(c)).alias(c) for c in ("words", "anchor"))), "settled")
    return whole.filter("open is null or not open").select(*settled.columns).unionByName(settled)


def windows_of(left: DataFrame, window: int) -> DataFrame:
    """The windows of segments that :func:`crowded_segments` has left, without words."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["d", "content", "start", "key", "check", "words"]
        for batch in batches:
            parts: list[tuple] = []
            for d, content, first, text in rows_of(batch):
                words = text.split()
                key, check = window_hashes(words, word_hashes(words), window)
                parts.append((np.full(len(key), d), np.full(len(key), content), first + np.arange(len(key)),
                              key.view(np.int64), check.view(np.int64)))
            if parts:
                columns = [pa.array(np.concatenate(c), pa.int64()) for c in zip(*parts, strict=True)]
                yield pa.RecordBatch.from_arrays([*columns, pa.nulls(len(columns[0]), pa.binary())], names)

    return left.select("d", "content", "first", "words").mapInArrow(
        scan, "d long, content long, start long, key long, check long, words binary")


def crowded_windows(segments: DataFrame, window: int) -> DataFrame:
    """Windows of crowded anchors that go: d, content, first, end.  With key and
    check as well: those of the least document that a task saw of its first
    window, as an earlier task may have seen a smaller one; and, without a span,
    the least document of each task's last window.

    The windows are dealt by ranges of (key, check, d), so those of one key may
    take many tasks, and each comes after the least document of its key."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["d", "content", "first", "end", "key", "check"]
        last, least, groups = None, np.int64(0), 0
        for batch in batches:
            if not batch.num_rows:
                continue
            key, check, d, content, start = (c.to_numpy() for c in batch.columns)
            new = np.ones(len(d), dtype=bool)
            new[1:] = (key[1:] != key[:-1]) | (check[1:] != check[:-1])
            new[0] = last != (key[0], check[0])
            number = groups + np.cumsum(new)
            at = np.maximum.accumulate(np.where(new, np.arange(len(d)), -1))
            low = np.where(at >= 0, d[at], least)
            gone = d > low
            row = np.flatnonzero(gone | (number == 1))
            settled = gone[row]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c[row]) for c in (d, content, start, start + window)]
                + [pa.array(c[row], mask=settled) for c in (key, check)], names)
            last, least, groups = (key[-1], check[-1]), low[-1], number[-1]
        if last is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.array([v], pa.int64()) for v in (least, None, None, None, *last)], names)

    lone = segments.filter("words is null").select("key", "check", "d", "content", "start")
    ordered = lone.repartitionByRange("key", "check", "d").sortWithinPartitions("key", "check", "d")
    return ordered.mapInArrow(scan, "d long, content long, first long, end long, key long, check long")


def crowded_spans(windows: DataFrame) -> DataFrame:
    """The same for :func:`crowded_windows`: all but those of the least document go."""
    spans = windows.filter("key is null").select("d", "content", "first", "end")
    # a row per task at most
    least = windows.filter("first is null").groupBy("key", "check").agg(F.min("d").alias("least"))
    later = (windows.filter("key is not null and first is not null").join(F.broadcast(least), ["key", "check"])
             .filter("d > least").select("d", "content", "first", "end"))
    return spans.unionByName(later)


def keep(rows: DataFrame, spans: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 and, last, the kept text."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for doc_id, zipped, parts in zip(*batch.columns, strict=True):
                words = opened(zipped)
                left = words
                if parts.is_valid:
                    gone = np.zeros(len(words) + 1, dtype=np.int64)
                    both = parts.values.to_numpy()
                    first, end = both >> 32, both & 0xFFFFFFFF
                    np.add.at(gone, first, 1)
                    np.add.at(gone, end, -1)
                    left = [words[k] for k in np.flatnonzero(np.cumsum(gone)[:-1] == 0)]
                kept = b" ".join(left)
                out.append((doc_id.as_py(), len(words), len(words) - len(left), hashlib.sha256(kept).hexdigest(), kept))
            if out:
                kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)],
                    ["doc_id", "n_words", "n_removed", "kept_sha256", "kept"])

    per_text = spans.groupBy(F.col("d").alias("_d"), F.col("content").alias("_content")).agg(
        # a span in one long: half the bytes of a struct to shuffle
        F.collect_list(F.shiftleft("first", 32).bitwiseOR(F.col("end"))).alias("spans"))
    joined = rows.join(per_text, (F.col("d") == F.col("_d")) & (F.col("content") == F.col("_content")), "left")
    return joined.select("doc_id", "zipped", "spans").mapInArrow(
        scan, "doc_id long, n_words long, n_removed long, kept_sha256 string, kept binary")


def deduplicated(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, crowd: int = CROWD) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 and kept (the kept words) of every document."""
    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("d"),
                       F.xxhash64("text").alias("content"), F.col("text").cast("binary"))
    texts = compact(rows)
    with temporary(docs.sparkSession):
        with temporary(docs.sparkSession):  # the list of all anchors goes as soon as the shared ones are known
            shared = saved(shared_anchors(saved(listed_anchors(rows, window, gram, crowd), "anchors"), crowd), "shared", keep=True)
        segments = saved(segments_of(texts, shared, window, gram), "segments")
        whole = crowded_segments(segments)
        left = whole.filter("anchor is not null")
        # a row per ``crowd`` segments at most
        dense = saved(left.groupBy("anchor").agg(F.count("*").alias("rows")).filter(F.col("rows") > crowd).select("anchor"), "dense")
        # written before they are sorted: sorting by range reads its input twice
        windows = saved(windows_of(left.join(F.broadcast(dense), "anchor", "left_semi"), window), "windows")
        crowded = saved(crowded_windows(windows, window), "crowded")
        few = left.join(F.broadcast(dense), "anchor", "left_anti").select(
            F.col("anchor").alias("key"), "d", "content", F.col("first").alias("start"), "words")
        shards = segments.filter("anchor is null").select("key", "d", "content", "start", "words").unionByName(few)
        gone = whole.filter("anchor is null").select("d", "content", "first", "end").unionByName(crowded_spans(crowded))
        spans = saved(shard_spans(shards, window).unionByName(gone), "spans", keep=True)
    return keep(texts, spans)


def substring_dedup(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, crowd: int = CROWD) -> DataFrame:
    """doc_id, n_words, n_removed and the SHA-256 of the kept words joined by a space."""
    return deduplicated(docs, window, gram, crowd).select("doc_id", "n_words", "n_removed", "kept_sha256")
