"""SimHash near-duplicates by covering locality-sensitive hashing.

A fingerprint bit is 1 if more than half of a text's shingle hashes have it.
Fingerprints link at ``RADIUS`` or fewer differing bits.

1. Equal fingerprints are one node, however many documents have them.
2. Covering: every bit position gets a non-zero vector of RADIUS + 1 bits, and
   each of the 2^(RADIUS + 1) - 1 non-zero vectors v is a table, whose mask keeps
   the positions with an odd product with v.  RADIUS differing positions have
   RADIUS vectors, and some v has even products with all of them: its mask
   keeps none of the differing bits, so the pair shares a bucket of that table.
   No pair within the radius is missed.
3. Buckets of up to ``few`` fingerprints compare their pairs by counting bits.
4. A larger bucket (a family of copies) makes no pairs.  Its members differ in
   the bits outside its mask only; each is listed under itself and under what
   one flipped bit of these makes of it.  Two fingerprints share a listing
   exactly if they differ in at most two bits, so all of a listing link with
   its least one.  That is exact for ``RADIUS`` 2, the only one offered.

Links give components.  A component's id is the least doc_id of its documents.

Defined results: a null, empty or blank text has fingerprint zero, which links
like any other; fewer than three words are one shingle; rows that repeat a
doc_id or a text are each returned; a null doc_id is greater than all others (a
component of null ids has a null id); an empty table gives an empty result;
other columns of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paylens.llm.common import saved, temporary
from paylens.llm.components import components

BITS = 64
RADIUS = 2
SHINGLE = 3
SEED = 42
FEW = 16
_CHUNK = 1 << 16


def fingerprint(text: bytes, width: int = SHINGLE) -> int:
    """The SimHash of a text (unsigned)."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= width:
        return xxhash.xxh64_intdigest(joined, SEED)
    ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    first, last = starts[:len(words) - width + 1].tolist(), ends[width - 1:].tolist()
    ones = np.zeros(BITS, dtype=np.int64)
    digest = xxhash.xxh64_intdigest
    for k in range(0, len(first), _CHUNK):
        part = first[k:k + _CHUNK]
        h = np.fromiter((digest(joined[a:b], SEED) for a, b in zip(part, last[k:k + _CHUNK], strict=True)),
                        dtype="<u8", count=len(part))
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return sum(1 << k for k in np.flatnonzero(2 * ones > len(first)).tolist())


def fingerprints(docs: DataFrame, width: int = SHINGLE) -> DataFrame:
    """doc_id, print (the fingerprint as a signed long) of every document."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = np.array([fingerprint(t.as_py() or b"", width) for t in batch.column(1)], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(prints.view(np.int64), pa.int64())], ["doc_id", "print"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary")).mapInArrow(scan, "doc_id long, print long")


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def masks(radius: int = RADIUS) -> list[int]:
    """The structured masks, as signed longs: a table each.  Positions take the
    non-zero vectors in turn."""
    vectors = range(1, 1 << (radius + 1))
    of = [1 + k % len(vectors) for k in range(BITS)]
    return [_signed(sum(1 << k for k in range(BITS) if (of[k] & v).bit_count() % 2)) for v in vectors]


def buckets(prints: DataFrame) -> DataFrame:
    """mask, bucket, print: a row per table of every distinct fingerprint."""
    tables = F.array(*[F.lit(m).cast("long") for m in masks()])
    return prints.select("print", F.explode(tables).alias("mask")).select(
        "mask", F.col("print").bitwiseAND(F.col("mask")).alias("bucket"), "print")


def covered_links(prints: DataFrame, few: int = FEW) -> DataFrame:
    """a, b: links between distinct fingerprints (``print``) that give all
    components; every pair that shares a bucket of up to ``few`` is among them
    if it is within the radius."""
    listed = saved(buckets(prints), "buckets")
    sizes = listed.groupBy("mask", "bucket").agg(F.count("*").alias("size")).filter("size > 1")
    shared = saved(listed.join(sizes, ["mask", "bucket"]), "shared")
    small = shared.filter(F.col("size") <= few)
    left, right = (small.select("mask", "bucket", F.col("print").alias(s)) for s in "ab")
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= RADIUS
    pairs = left.join(right, ["mask", "bucket"]).filter((F.col("a") < F.col("b")) & near).select("a", "b")

    flips = F.array(F.lit(0).cast("long"), *[F.lit(_signed(1 << k)).cast("long") for k in range(BITS)])
    crowded = shared.filter(F.col("size") > few).select(
        "print", F.explode(F.filter(flips, lambda bit: bit.bitwiseAND(F.col("mask")) == 0)).alias("bit"))
    listings = saved(crowded.select("print", F.col("print").bitwiseXOR(F.col("bit")).alias("under")).distinct(), "listings")
    least = listings.groupBy("under").agg(F.min("print").alias("b"), F.max("print").alias("most")).filter("b < most")
    stars = listings.join(least, "under").filter("print > b").select(F.col("print").alias("a"), "b")
    return pairs.unionByName(stars).distinct()


def simhash_components(docs: DataFrame, few: int = FEW, width: int = SHINGLE) -> DataFrame:
    """doc_id, fingerprint (16 hexadecimal digits) and component_id of every document."""
    with temporary(docs.sparkSession):
        rows = saved(fingerprints(docs, width), "prints", keep=True)
        # copies meet here, after a map-side combine
        nodes = saved(rows.groupBy("print").agg(F.min("doc_id").alias("least")), "nodes")
        known = components(covered_links(nodes.select("print"), few))
        placed = nodes.join(known, F.col("print") == F.col("node"), "left").select(
            "print", "least", F.coalesce("component", "print").alias("component"))
        placed = saved(placed, "placed")
        ids = placed.groupBy("component").agg(F.min("least").alias("component_id"))
        named = saved(placed.join(ids, "component").select(F.col("print").alias("_print"), "component_id"), "named", keep=True)
    return rows.join(named, F.col("print") == F.col("_print")).select(
        "doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id")
