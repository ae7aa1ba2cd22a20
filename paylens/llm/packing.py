"""Packing documents into fixed-length sequences by pattern packing.

Documents become token pieces of at most ``length`` tokens.  The histogram of
piece lengths (at most ``length`` rows) goes to the driver.  There, patterns of
two or three lengths that fill a sequence are enumerated, their repeat counts
are fitted to the histogram by non-negative least squares and rounded down,
and what is left is packed largest first.  Spark numbers the pieces of each
length and looks each number up in the table of pattern slots, whose size
depends on ``length`` alone.

A text that the fast encoder cannot cut (a run of about a million blanks ends its
pattern search) is encoded by the public tokenizer library, with the same ids.

Defined results: a null or empty text is the end token alone; repeated rows
(or doc_ids) are packed separately; an empty table gives an empty result;
other columns of the input are ignored.
"""

from __future__ import annotations

import base64
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paylens.llm.common import running, saved

END = 0
ADDED = {"<|endoftext|>": 50256}  # the added tokens of byte_bpe_50k.json: one id wherever a text holds the string
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def vocabulary() -> str:
    """The default vocabulary: byte_bpe_50k.json, as the ranks in its twin file."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def encoder(path: str):
    """Byte-level BPE with the ids of byte_bpe_50k.json."""
    import public_tokenizers
    import tiktoken

    with open(path, "rb") as file:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
    return tiktoken.Encoding("byte_bpe_50k", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                             special_tokens=ADDED)


class Coder:
    """The ids of any text."""

    def __init__(self, path: str) -> None:
        self.path, self.fast, self.thorough = path, encoder(path), None

    def ids(self, text: str) -> list[int]:
        try:
            return self.fast.encode(text, allowed_special="all")
        except ValueError:
            if self.thorough is None:
                import tokenizers

                self.thorough = tokenizers.Tokenizer.from_file(self.path.removesuffix(".tiktoken") + ".json")
            return self.thorough.encode(text, add_special_tokens=False).ids


def cuts(n: int, length: int) -> list[tuple[int, int]]:
    """(start, end) of the pieces of n tokens; only the first may be short."""
    first = n % length or length
    return [(max(0, end - length), end) for end in range(first, n + 1, length)]


def token_pieces(docs: DataFrame, length: int = 2048, path: str | None = None) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32."""
    path = path or vocabulary()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder(path)
        names = ["doc_id", "piece", "start", "length", "ids_crc32"]
        for batch in batches:
            out: list[tuple] = []
            for doc_id, text in zip(batch.column(0), batch.column(1), strict=True):
                ids = np.array([*coder.ids(text.as_py() or ""), END], dtype="<u4")
                for k, (a, b) in enumerate(cuts(len(ids), length)):
                    out.append((doc_id.as_py(), k, a, b - a, zlib.crc32(ids[a:b].tobytes())))
            if out:
                kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)], names)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(encode, PIECES)


def patterns_of(present: np.ndarray, length: int, picks: int = 3) -> np.ndarray:
    """Patterns of two and three present lengths that fill a sequence best.

    Rows of three lengths, 0 for none.  For each length: with the longest
    that still fits; and, for ``picks`` second lengths spread over those that
    fit, with the longest third.
    """
    present = np.sort(present)
    largest = np.zeros(length + 1, dtype=np.int64)
    largest[present] = present
    largest = np.maximum.accumulate(largest)
    found = [(a, largest[length - a], 0) for a in present]
    for a in present:
        fitting = present[:np.searchsorted(present, length - a, side="right")]
        for b in fitting[np.linspace(0, len(fitting) - 1, picks + 2).astype(int)[1:-1]] if len(fitting) else ():
            found.append((a, b, largest[length - a - b]))
    return np.unique(np.sort(np.array(found, dtype=np.int64), axis=1)[:, ::-1], axis=0)


def fitted(patterns: np.ndarray, counts: np.ndarray, rounds: int = 400) -> np.ndarray:
    """Non-negative repeat counts x that minimise |A x - counts|^2, where A says
    how often each pattern holds each length: accelerated projected gradient."""
    width = len(counts)

    def forward(x: np.ndarray) -> np.ndarray:
        y = np.bincount(patterns.ravel(), weights=np.repeat(x, patterns.shape[1]), minlength=width)
        y[0] = 0
        return y

    def back(r: np.ndarray) -> np.ndarray:
        return r[patterns].sum(axis=1)

    v = np.ones(len(patterns))
    for _ in range(20):  # the largest eigenvalue of A'A
        v = back(forward(v))
        size = np.linalg.norm(v)
        v /= size
    x = y = np.zeros(len(patterns))
    t = 1.0
    for _ in range(rounds):
        new = np.maximum(0, y - back(forward(y) - counts) / (1.05 * size))
        after = (1 + (1 + 4 * t * t) ** 0.5) / 2
        y = new + (t - 1) / after * (new - x)
        x, t = new, after
    return x


def plan(histogram: dict[int, int], length: int) -> list[tuple[tuple[int, ...], int]]:
    """(lengths, repeats) of the patterns that use up the histogram."""
    left = np.zeros(length + 1, dtype=np.int64)
    for size, n in histogram.items():
        left[size] = n
    out: list[tuple[tuple[int, ...], int]] = []

    def use(sizes: list[int], most: int) -> None:
        held, times = np.unique(sizes, return_counts=True)
        n = int(min(most, (left[held] // times).min()))
        if n > 0:
            left[held] -= n * times
            out.append((tuple(int(s) for s in sorted(sizes, reverse=True)), n))

    present = np.flatnonzero(left)
    if len(present):
        patterns = patterns_of(present, length)
        repeats = np.floor(fitted(patterns, left.astype(float))).astype(np.int64)
        waste = length - patterns.sum(axis=1)
        for k in np.lexsort((-repeats, waste)):
            if repeats[k] and waste[k] * 200 <= length:
                use([s for s in patterns[k] if s], repeats[k])
    while len(present := np.flatnonzero(left)):  # residuals: the largest first, then the largest that fits
        sizes, room, spare = [], length, left.copy()
        while room > 0 and len(fit := np.flatnonzero(spare[:room + 1])):
            size = int(fit[-1])
            n = min(int(spare[size]), room // size)
            sizes += [size] * n
            room -= n * size
            spare[size] = 0
        use(sizes, 1 << 60)
    return out


def slots_of(patterns: list[tuple[tuple[int, ...], int]]) -> list[tuple[int, int, int, int, int, int]]:
    """(length, first, end, sequence, times, offset) of each length of each
    pattern: the pieces numbered first to end - 1 of that length go there."""
    used: dict[int, int] = {}
    out, sequence = [], 0
    for sizes, repeats in patterns:
        offset = 0
        for size in dict.fromkeys(sizes):
            times = sizes.count(size)
            first = used.get(size, 0)
            used[size] = first + times * repeats
            out.append((size, first, used[size], sequence, times, offset))
            offset += times * size
        sequence += repeats
    return out


def packed(docs: DataFrame, length: int = 2048, path: str | None = None) -> DataFrame:
    """The pieces with ``sequence_id`` and ``offset``; full pieces have a
    sequence (below zero) each."""
    pieces = saved(token_pieces(docs, length, path), "pieces")
    short = pieces.filter(F.col("length") < length)
    # at most length - 1 rows
    histogram = {r["length"]: r["count"] for r in short.groupBy("length").count().collect()}
    rows = slots_of(plan(histogram, length))
    slots = docs.sparkSession.createDataFrame(
        rows, "_length long, _first long, _end long, _sequence long, _times long, _offset long")
    numbered = running(short.withColumn("one", F.lit(1)), ["length"], ["doc_id", "piece"], "one", "number")
    within = F.col("number") - F.col("_first")
    placed = numbered.join(F.broadcast(slots), (F.col("length") == F.col("_length"))
                           & (F.col("number") >= F.col("_first")) & (F.col("number") < F.col("_end")))
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    placed = placed.select(*columns, (F.col("_sequence") + F.floor(within / F.col("_times"))).alias("sequence_id"),
                           (F.col("_offset") + within % F.col("_times") * F.col("length")).alias("offset"))
    full = pieces.filter(F.col("length") == length).select(
        *columns, (-1 - F.monotonically_increasing_id()).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    return placed.unionByName(full)
