"""Document fingerprints by MinHash.

A fingerprint holds ``PERMS`` numbers: for each universal hash permutation, the
least hash of the text's five-word shingles (words lower-cased A-Z), cut to 16
bits.  The share of equal numbers estimates the Jaccard similarity of two
texts.  All permutations of a block of shingles are taken at once in numpy.

``near_links`` joins bands of the fingerprints in Spark and keeps the links
whose exact Jaccard similarity is high enough.

Defined results: a null text is empty; an empty or blank text has the
fingerprint of the empty set (equal to itself, unlike all others); fewer than
five words make one shingle; rows that repeat a doc_id are ordered by their
texts; a null doc_id comes first; an empty table gives an empty result; other
columns of the input are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from paylens.llm.common import saved, shingle_set, temporary
from paylens.llm.components import components
from paylens.llm.ngram_join import _apart, class_of, sets_of, shingles, verified

PERMS = 128
BANDS = 25  # of five numbers: at a similarity of 0.8 all but one pair in 20,000 share a band
SEED = 20240229
_CHUNK = 2048


def permutations(perms: int = PERMS, seed: int = SEED) -> tuple[np.ndarray, np.ndarray]:
    """Odd multipliers and offsets of the universal hash functions."""
    rng = np.random.default_rng(seed)
    multiply = rng.integers(0, 2**64, perms, dtype=np.uint64) | np.uint64(1)
    return multiply, rng.integers(0, 2**64, perms, dtype=np.uint64)


def minhash(shingles: np.ndarray, multiply: np.ndarray, offset: np.ndarray) -> np.ndarray:
    """The least hash under each permutation, its 16 bits below the top 16; the
    empty set has all ones."""
    least = np.full(len(multiply), np.iinfo(np.uint64).max, dtype=np.uint64)
    for at in range(0, len(shingles), _CHUNK):
        block = shingles[at:at + _CHUNK, None] * multiply
        block += offset
        np.minimum(least, block.min(axis=0), out=least)
    return (least >> np.uint64(16)).astype("<u2")


def printed(text: bytes, multiply: np.ndarray, offset: np.ndarray) -> np.ndarray:
    return minhash(shingle_set(text.lower().split()), multiply, offset)


def edited(text: str, following: str) -> str:
    """``text``, its last half replaced by the start of the next text."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


_FIELDS = [("part", pa.int32()), ("kind", pa.int32()), ("doc_id", pa.int64()), ("text", pa.string()),
           ("n_chars", pa.int64()), ("edited_sha256", pa.binary()), ("fingerprint", pa.binary()),
           ("edited_fingerprint", pa.binary()), ("near_edited", pa.float64()), ("near_next", pa.float64())]
SCHEMA = ("part int, kind int, doc_id long, text string, n_chars long, edited_sha256 binary, fingerprint binary, "
          "edited_fingerprint binary, near_edited double, near_next double")
DONE, HEAD, TAIL = 0, 1, 2


def _row(doc_id, text: str, mark: np.ndarray, following: str, next_mark: np.ndarray, perms: tuple) -> tuple:
    other = edited(text, following)
    raw = other.encode()
    other_mark = printed(raw, *perms)
    return (0, DONE, doc_id, None, len(text), hashlib.sha256(raw).digest(), mark.tobytes(), other_mark.tobytes(),
            float((mark == other_mark).mean()), float((mark == next_mark).mean()))


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(zip(*rows, strict=True), _FIELDS, strict=True)],
                                      [n for n, _ in _FIELDS])


def fingerprints(docs: DataFrame, perms: int = PERMS) -> DataFrame:
    """Every document's fingerprint, that of its edited text, and their likeness
    to each other and to the next document's.

    The texts are range-partitioned by doc_id and read in order, one row
    ahead.  The first and the last text of each range are joined afterwards.
    """
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = permutations(perms)
        part = TaskContext.get().partitionId()
        before = None
        for batch in batches:
            out = []
            for doc_id, text in zip(*batch.columns, strict=True):
                text = text.as_py()
                mark = printed(text.encode(), *hashes)
                if before is None:
                    out.append((part, HEAD, doc_id.as_py(), text, *[None] * 6))
                else:
                    out.append(_row(*before, text, mark, hashes))
                before = (doc_id.as_py(), text, mark)
                if len(out) >= 1000:
                    yield _batch(out)
                    out = []
            if out:
                yield _batch(out)
        if before is not None:
            yield _batch([(part, TAIL, before[0], before[1], *[None] * 6)])

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = permutations(perms)
        for batch in batches:
            out = []
            for doc_id, text, following in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                out.append(_row(doc_id, text, printed(text.encode(), *hashes), following,
                                printed(following.encode(), *hashes), hashes))
            if out:
                yield _batch(out)

    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    ordered = rows.repartitionByRange("doc_id", F.xxhash64("text")).sortWithinPartitions("doc_id", F.xxhash64("text"))
    table = saved(ordered.mapInArrow(scan, SCHEMA), "prints")
    # two rows for each range; a range's last text is followed by the next range's first, the last by the very first.
    # Only the numbers of the ranges meet in one task, their texts are joined
    ends = table.filter(F.col("kind") != DONE).select("part", "kind", "doc_id", "text")
    heads = ends.filter(F.col("kind") == HEAD).select(F.col("part").alias("next"), F.col("text").alias("following"))
    order = Window.partitionBy().orderBy("part")
    every = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    after = heads.select(F.col("next").alias("part")).select(
        F.col("part").alias("_part"), F.coalesce(F.lead("part").over(order), F.first("part").over(every)).alias("_next"))
    ends = (ends.filter(F.col("kind") == TAIL).join(after, F.col("part") == F.col("_part"))
            .join(heads.hint("merge"), F.col("_next") == F.col("next")).select("doc_id", "text", "following"))
    columns = [n for n, _ in _FIELDS if n not in ("part", "kind", "text")]
    rows = (table.filter(F.col("kind") == DONE).select(*columns)
            .unionByName(ends.repartition("doc_id").mapInArrow(join, SCHEMA).select(*columns)))
    # in hexadecimal only here: the written table holds bytes
    return rows.withColumns({c: F.lower(F.hex(c)) for c in ("edited_sha256", "fingerprint", "edited_fingerprint")})


def near_links(docs: DataFrame, percent: int = 80, bands: int = BANDS, perms: int = PERMS) -> DataFrame:
    """a, b: documents linked by a band and by exact Jaccard similarity.

    Equal shingle sets are one class, named by its least doc_id and linked with
    its other documents.  In each band, every class is compared with the least
    of equal band numbers; then classes of equal band numbers that are not in
    one component yet are compared with each other.  So the links give the
    components of all similar pairs that share a band, while a family of
    copies never makes all its pairs.

    Documents without words are linked with nothing.  A null doc_id is greater
    than all others: it comes as ``b``, as ``a`` too if both are null.  Rows
    that repeat a doc_id are not linked with each other.
    """
    with temporary(docs.sparkSession):
        return saved(_links(docs, percent, bands, perms), "links", keep=True)


def _links(docs: DataFrame, percent: int, bands: int, perms: int) -> DataFrame:
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = permutations(perms)
        width = perms // bands
        for batch in batches:
            out: list[tuple] = []
            seen = set()
            for doc_id, key, text in zip(*batch.columns, strict=True):
                tokens = shingles(text.as_py() or b"")
                if not len(tokens):
                    continue
                name, keys = class_of(tokens), None
                if name not in seen:
                    seen.add(name)
                    mark = minhash(tokens.view(np.uint64), *hashes)
                    keys = [bytes([k]) + mark[k * width:(k + 1) * width].tobytes() for k in range(bands)]
                out.append((doc_id.as_py(), key.as_py(), name, len(tokens), keys))
            if out:
                kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.list_(pa.binary())]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)],
                                                 ["doc_id", "key", "class", "n", "bands"])

    # a row is found again by the hash of its doc_id and text
    rows = docs.select(F.col("doc_id").cast("long"), "text").withColumn("key", F.xxhash64("doc_id", "text"))
    table = rows.select("doc_id", "key", F.col("text").cast("binary")).mapInArrow(
        scan, "doc_id long, key long, class long, n int, bands array<binary>")
    table = saved(table.withColumn("row", F.monotonically_increasing_id()), "bands")
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row", "key")
    classes = saved(table.groupBy("class").agg(F.min(place).alias("one")), "classes")

    banded = table.filter("bands is not null").select(F.explode("bands").alias("band"), "class", "n").distinct()
    banded = saved(banded, "banded")
    least = banded.groupBy("band").agg(F.min("class").alias("a"), F.max("class").alias("most")).filter("a < most")
    shared = saved(banded.join(least.select("band", "a"), "band"), "shared")
    wanted = classes.join(shared.select("class").distinct(), "class").select("class", F.col("one.key").alias("doc_id"))
    sets = saved(sets_of(rows.select(F.col("key").alias("doc_id"), "text"), wanted), "sets")
    stars = shared.filter("a < class").select("a", F.col("class").alias("b")).distinct()
    links = saved(verified(stars, sets, percent), "stars")

    known = saved(components(links), "components")
    placed = shared.drop("a").join(known, F.col("class") == F.col("node"), "left").select(
        "band", "class", "n", F.col("n").alias("left"), F.coalesce("component", "class").alias("component"))
    links = links.unionByName(verified(_apart(placed, "band", percent), sets, percent))

    for side in "ab":
        links = links.join(classes.select(F.col("class").alias(side), F.col("one").alias(f"one_{side}")), side)
    links = links.select(F.least("one_a", "one_b")["doc_id"].alias("a"), F.greatest("one_a", "one_b")["doc_id"].alias("b"))
    copies = table.join(classes, "class").filter(F.col("row") != F.col("one.row")).select(
        F.col("one.doc_id").alias("a"), F.col("doc_id").alias("b"))
    return links.unionByName(copies).filter("a is null or b is null or a < b")
