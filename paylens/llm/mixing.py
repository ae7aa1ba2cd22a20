"""Mixing sources to target weights.

The words of a source, its documents one after another, are cut into blocks
of fixed length.  Output shards draw multinomial source counts; the slots of
a source are numbered over the shards; each slot is mapped through a
pseudo-random permutation of the source's block numbers, a new one for every
pass over the source; blocks are joined by number.  Drawn counts scatter, so
slots beyond a source's quota are handed to the sources short of theirs: each
source gives its target, rounded down, to the word.

The mixture (a weight per source) is a setting, held on the driver, and so is
one row per source; over ``MAX_SOURCES`` of them raise an error.

Defined results: a null source is a source of its own, last in order; a null,
empty or blank text has size 0 and is never taken; repeated rows are taken
separately; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paylens.llm.common import boxed, mixed, running, saved, temporary, unboxed, words

BLOCK = 512
SHARD_SLOTS = 4096
WEIGHTS = (5, 2, 1)
MOST_TIMES = 3
MAX_SOURCES = 100_000


def targets_of(sizes: list[int], weights: list[float], most: float = MOST_TIMES) -> list[float]:
    """Words per source: shares of all words by weight, none above ``most`` times
    its size; what is above goes to the others by weight."""
    size, weight = np.array(sizes, dtype=float), np.array(weights, dtype=float)
    target = np.zeros(len(size))
    open_ = np.ones(len(size), dtype=bool)
    while open_.any():
        rest = size.sum() - most * size[~open_].sum()
        target[open_] = rest * weight[open_] / weight[open_].sum()
        above = open_ & (target > most * size)
        if not above.any():
            break
        target[above] = most * size[above]
        open_ &= ~above
    return target.tolist()


def permuted(index: np.ndarray, size: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Image of each index under a keyed permutation of 0 .. size - 1: a Feistel
    network on the next power of four, walked until the image is in range."""
    index, size, key = (np.asarray(a, dtype=np.uint64) for a in (index, size, key))
    half = np.maximum(1, np.ceil(np.log2(np.maximum(size, 2).astype(float)) / 2)).astype(np.uint64)
    mask = (np.uint64(1) << half) - np.uint64(1)

    def once(x: np.ndarray, half: np.ndarray, mask: np.ndarray, key: np.ndarray) -> np.ndarray:
        left, right = x >> half, x & mask
        for turn in range(4):
            left, right = right, left ^ (mixed(right + mixed(key + np.uint64(turn))) & mask)
        return (left << half) | right

    out = once(index, half, mask, key)
    while (away := out >= size).any():
        out[away] = once(out[away], half[away], mask[away], key[away])
    return out.astype(np.int64)


@dataclass
class Mixture:
    """What every task needs to know of the sources, in their order."""

    names: list
    sizes: np.ndarray
    targets: np.ndarray
    block: int = BLOCK
    seed: int = 0
    drawn: np.ndarray = field(default_factory=lambda: np.empty(0, dtype=np.int64))

    def __post_init__(self) -> None:
        self.want = np.floor(self.targets + 1e-6).astype(np.int64)
        size = np.maximum(self.sizes, 1)
        self.blocks = -(-self.sizes // self.block)
        self.passes, self.rest = self.want // size, self.want % size
        self.quota = self.passes * self.blocks + -(-self.rest // self.block)

    def draw(self, shard: int, slots: int) -> np.ndarray:
        """The source counts of one shard."""
        odds = self.quota / self.quota.sum()
        return np.random.default_rng([self.seed, shard]).multinomial(slots, odds / odds.sum())

    def moved(self, source: np.ndarray, slot: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Slots beyond a quota become slots of the sources that drew too few."""
        over, short = np.maximum(self.drawn - self.quota, 0), np.maximum(self.quota - self.drawn, 0)
        ends = np.cumsum(short)
        extra = slot >= self.quota[source]
        place = (np.cumsum(over) - over)[source[extra]] + slot[extra] - self.quota[source[extra]]
        to = np.searchsorted(ends, place, side="right")
        source, slot = source.copy(), slot.copy()
        source[extra], slot[extra] = to, self.drawn[to] + place - (ends - short)[to]
        return source, slot

    def taken(self, source: np.ndarray, slot: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Pass, block number and words of each slot.  The short block of a
        source comes last in every pass, the last slot of all may be cut."""
        blocks, whole = self.blocks[source], self.sizes[source] // self.block
        turn, place = slot // blocks, slot % blocks
        number = place.copy()
        inner = place < whole
        key = mixed((source.astype(np.uint64) << np.uint64(20)) + turn.astype(np.uint64)
                    + np.uint64(self.seed & 0xFFFFFFFF) * np.uint64(0x9E3779B97F4A7C15))
        number[inner] = permuted(place[inner], whole[inner], key[inner])
        size = np.where(inner, self.block, self.sizes[source] % self.block)
        rest = self.rest[source]
        last = (slot == self.quota[source] - 1) & (rest > 0)
        return turn, number, np.where(last, rest - (-(-rest // self.block) - 1) * self.block, size)


def sized_rows(docs: DataFrame) -> DataFrame:
    """row, doc_id, source, content (hash of the text) and size of every document."""
    return saved(docs.select("doc_id", "source", F.xxhash64("text").alias("content"),
                             F.size(words(F.col("text"))).cast("long").alias("size"))
                 .withColumn("row", F.monotonically_increasing_id()), "sized")


def mixture_of(sized: DataFrame, weights: tuple[float, ...] = WEIGHTS, block: int = BLOCK, seed: int = 0) -> Mixture:
    """The sources by code point, null last, with weights in turn."""
    sums = sized.groupBy("source").agg(F.sum("size").alias("size")).limit(MAX_SOURCES + 1).collect()
    if len(sums) > MAX_SOURCES:
        raise ValueError(f"a mixture of over {MAX_SOURCES} sources")
    sums.sort(key=lambda r: (r["source"] is None, r["source"] or ""))
    sizes = [r["size"] for r in sums]
    weight = [weights[k % len(weights)] for k in range(len(sums))]
    return Mixture([r["source"] for r in sums], np.array(sizes, dtype=np.int64), np.array(targets_of(sizes, weight)),
                   block, seed)


def slots(spark, mixture: Mixture, shard_slots: int = SHARD_SLOTS) -> DataFrame:
    """shard, _source, turn, block, words of every slot of the mix."""
    total = int(mixture.quota.sum())
    shards = -(-total // shard_slots)

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard in batch.column(0).to_pylist():
                counts = mixture.draw(shard, min(shard_slots, total - shard * shard_slots))
                hit = np.flatnonzero(counts)
                yield pa.RecordBatch.from_pydict({"shard": np.full(len(hit), shard), "_source": hit,
                                                  "count": counts[hit]})

    counts = saved(spark.range(shards).mapInArrow(draw, "shard long, _source long, count long"), "counts")
    mixture.drawn = np.zeros(len(mixture.sizes), dtype=np.int64)
    for r in counts.groupBy("_source").agg(F.sum("count").alias("n")).collect():  # a row for each source at most
        mixture.drawn[r["_source"]] = r["n"]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            shard, source, count, first = (c.to_numpy() for c in batch.columns)
            slot = np.repeat(first - (np.cumsum(count) - count), count) + np.arange(count.sum())
            source, slot = mixture.moved(np.repeat(source, count), slot)
            turn, number, size = mixture.taken(source, slot)
            yield pa.RecordBatch.from_pydict({"shard": np.repeat(shard, count), "_source": source, "turn": turn,
                                              "block": number, "words": size})

    numbered = running(counts, ["_source"], ["shard"], "count", "first")
    return numbered.mapInArrow(place, "shard long, _source long, turn long, block long, words long")


def _sources(spark, mixture: Mixture) -> DataFrame:
    rows = [(k, name, int(size), float(target)) for k, (name, size, target)
            in enumerate(zip(mixture.names, mixture.sizes, mixture.targets, strict=True))]
    return spark.createDataFrame(rows, "_source long, _name string, source_size long, target double")


def takes(sized: DataFrame, mixture: Mixture) -> DataFrame:
    """row, turn, first, end: the words of a document that the mix takes in a
    pass, block by block."""
    spark = sized.sparkSession
    names = F.broadcast(_sources(spark, mixture).select("_source", "_name"))  # MAX_SOURCES rows at most
    at = running(sized.filter("size > 0"), ["source"], ["doc_id", "content"], "size", "start")
    at = at.join(names, F.col("source").eqNullSafe(F.col("_name")))
    size = F.lit(mixture.block)

    def block(position: Column) -> Column:
        return F.floor(position / size).cast("long")

    spans = at.select("row", "_source", "start", "size", F.explode(F.sequence(
        block(F.col("start")), block(F.col("start") + F.col("size") - 1))).alias("block"))
    joined = spans.join(slots(spark, mixture), ["_source", "block"])
    begin = F.col("block") * size
    first = F.greatest(begin, F.col("start")) - F.col("start")
    end = F.least(begin + F.col("words"), F.col("start") + F.col("size")) - F.col("start")
    return joined.select("row", "turn", first.alias("first"), end.alias("end")).filter(F.col("end") > F.col("first"))


def mix(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, block: int = BLOCK, seed: int = 0) -> DataFrame:
    """doc_id, size, source_size, target and taken of every document."""
    sized = sized_rows(docs)
    mixture = mixture_of(sized, weights, block, seed)
    if not mixture.quota.sum():
        taken = sized.select(F.col("row").alias("_row"), F.lit(0).cast("long").alias("taken"))
    else:
        taken = takes(sized, mixture).groupBy(F.col("row").alias("_row")).agg(
            F.sum(F.col("end") - F.col("first")).alias("taken"))
    info = F.broadcast(_sources(docs.sparkSession, mixture))
    return (sized.join(info, F.col("source").eqNullSafe(F.col("_name")))
            .join(taken, F.col("row") == F.col("_row"), "left")
            .select("doc_id", "size", "source_size", "target",
                    F.coalesce(F.col("taken"), F.lit(0)).cast("long").alias("taken")))


def mixed_documents(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, block: int = BLOCK,
                    seed: int = 0) -> DataFrame:
    """The mix as documents, in the columns of ``docs``: a row for each pass in
    which a document is taken, with its text, or, if the pass takes a part of
    it, the taken words joined by spaces (``n_chars`` follows)."""
    key = ["doc_id", "source", "content"]
    with temporary(docs.sparkSession):
        sized = sized_rows(docs)
        mixture = mixture_of(sized, weights, block, seed)
        if not mixture.quota.sum():
            return docs.limit(0)
        spans = (takes(sized, mixture).groupBy("row", "turn")
                 .agg(F.sort_array(F.collect_list(F.struct("first", "end"))).alias("spans"),
                      F.sum(F.col("end") - F.col("first")).alias("n")))
        per_text = (spans.join(sized, "row")
                    .select(*[F.col(c).alias(f"_{c}") for c in key],
                            F.struct("spans", (F.col("n") == F.col("size")).alias("whole")).alias("take"))
                    .groupBy(*[f"_{c}" for c in key]).agg(F.collect_list("take").alias("_takes")))
        per_text = saved(per_text, "takes", keep=True)
    # rows alike in these three are one row here; their takes are all in _takes
    texts = boxed(docs, F.col("doc_id"), F.col("source"), F.col("text"), F.xxhash64("text").alias("content"))
    rows = texts.dropDuplicates(key).join(
        per_text, (F.col("content") == F.col("_content")) & F.col("doc_id").eqNullSafe(F.col("_doc_id"))
        & F.col("source").eqNullSafe(F.col("_source")))
    rows = rows.select("doc", "text", F.explode("_takes").alias("take"))
    cut = ~F.col("take.whole")
    rows = rows.withColumn("words", F.when(cut, words(F.col("text"))))
    part = F.array_join(F.flatten(F.transform(
        "take.spans", lambda s: F.slice(F.col("words"), (s["first"] + 1).cast("int"),
                                        (s["end"] - s["first"]).cast("int")))), " ")
    return unboxed(rows, docs.columns, part, cut)
