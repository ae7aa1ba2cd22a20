"""Helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from paylens.session import scratch_path

# A word is a run without space, tab, line feed, vertical tab, form feed or
# carriage return: what bytes.split() with no argument cuts out.
BLANKS = " \t\n\x0b\x0c\r"


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# Paths of the tables written within each open temporary() scope of this thread.
_scopes: ContextVar[tuple[list[str], ...]] = ContextVar("scopes", default=())


def saved(df: DataFrame, name: str, keep: bool = False) -> DataFrame:
    """``df`` written once to the shared folder (``spark.checkpoint.dir``) and
    read back.  This cuts the lineage: a lost executor never re-runs what
    made the table.  Within :func:`temporary` the table is deleted at the end
    of the scope, or of the next outer one if ``keep``."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    scopes = _scopes.get()[:-1] if keep else _scopes.get()
    if scopes:
        scopes[-1].append(path)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def temporary(spark: SparkSession) -> Iterator[None]:
    """Deletes the tables that ``saved`` writes within it, when it ends: what
    is still needed then must have been saved with ``keep``."""
    outer = _scopes.get()
    _scopes.set((*outer, []))
    try:
        yield
    finally:
        *_, paths = _scopes.get()
        _scopes.set(outer)
        for path in paths:
            where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def hashed_sample(rows: DataFrame, key: str, total: int, size: int) -> DataFrame:
    """About ``size`` of ``total`` rows, all if there are fewer: those whose key's
    hash is in the lowest share.  A filter: the same rows in every run, no sort."""
    share = min(1.0, size / max(1, total))
    return rows.filter(F.pmod(F.xxhash64(key), F.lit(1 << 40)) < F.lit(round(share * (1 << 40))))


def words(text: Column) -> Column:
    """The words of a text as an array; none for a null text."""
    flat = F.translate(F.coalesce(text, F.lit("")), BLANKS, " " * len(BLANKS))
    return F.array_remove(F.split(flat, " "), "")


def rows_of(batch: pa.RecordBatch) -> Iterator[tuple]:
    """The rows of an Arrow batch, one at a time (a text is never copied twice)."""
    return zip(*(map(_py, column) for column in batch.columns), strict=True)


def _py(scalar: pa.Scalar):
    return scalar.as_py()


def word_hashes(words: list[bytes], seed: int = 0) -> np.ndarray:
    """64-bit hashes of words, as an array."""
    digest = partial(xxhash.xxh3_64_intdigest, seed=seed) if seed else xxhash.xxh3_64_intdigest
    return np.fromiter(map(digest, words), dtype=np.uint64, count=len(words))


# Odd multipliers of a sliding hash: powers of one 64-bit constant.
_STEP = 0x9E3779B97F4A7C15
_ODD = [np.uint64(pow(_STEP, k + 1, 1 << 64) | 1) for k in range(64)]


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijective mix of 64-bit values (their order becomes pseudo-random)."""
    h = h ^ (h >> np.uint64(31))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def sliding_hashes(h: np.ndarray, width: int) -> np.ndarray:
    """Hash of every run of ``width`` consecutive items (empty if there is none)."""
    n = len(h) - width + 1
    if n <= 0:
        return np.empty(0, dtype=np.uint64)
    out = h[:n] * _ODD[0]
    for k in range(1, width):
        out += h[k:k + n] * _ODD[k]
    return mixed(out)


def shingle_set(words: list[bytes], width: int = 5) -> np.ndarray:
    """Sorted distinct hashes of the ``width``-word shingles.

    Fewer words than ``width`` make one shingle of them all; no words make
    an empty set.
    """
    if not words:
        return np.empty(0, dtype=np.uint64)
    h = word_hashes(words)
    if len(words) < width:
        return mixed((h * np.array(_ODD[:len(h)], dtype=np.uint64)).sum(keepdims=True, dtype=np.uint64)
                     + np.uint64(len(h)))
    return np.unique(sliding_hashes(h, width))


def signed(h: np.ndarray) -> np.ndarray:
    """The same 64 bits as Spark's (signed) long."""
    return np.asarray(h, dtype=np.uint64).view(np.int64)


def same(left: DataFrame, right: DataFrame, keys: list[str]) -> Column:
    """Null-safe equality on ``keys``."""
    cond = F.lit(True)
    for k in keys:
        cond = cond & left[k].eqNullSafe(right[k])
    return cond


def running(table: DataFrame, keys: list[str], order: list[str], weight: str, name: str) -> DataFrame:
    """``table`` plus ``name``: sum of ``weight`` over the earlier rows of the same ``keys``.

    Rows are range-partitioned by (keys, order), so a key with a third of
    all rows is cut into many ranges.  Each range is summed by itself and
    then shifted by the sums of the ranges before it: one row per (key,
    range).  ``table`` should be a narrow written table, as it is read twice.
    Equal rows take any order among themselves.
    """
    cut = saved(table.repartitionByRange(*[F.col(c) for c in keys + order]).withColumn("_range", F.spark_partition_id()),
                "ranges")
    sums = cut.groupBy(*keys, "_range").agg(F.sum(weight).alias("_sum"))
    before = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col("_range").alias("_r"),
                         F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_start"))
    inside = (Window.partitionBy("_range", *keys).orderBy(*order)
              .rowsBetween(Window.unboundedPreceding, -1))
    local = cut.withColumn("_local", F.coalesce(F.sum(weight).over(inside), F.lit(0)))
    cond = F.col("_range") == F.col("_r")
    for i, k in enumerate(keys):
        cond = cond & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    return (local.join(starts, cond)
            .withColumn(name, (F.col("_start") + F.col("_local")).cast("long"))
            .select(*table.columns, name))


def boxed(docs: DataFrame, *columns: Column) -> DataFrame:
    """``docs`` as one struct column ``doc`` beside computed ones, so that no
    column of the input can clash with an operator's own."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), *columns)


def unboxed(rows: DataFrame, columns: list[str], text: Column | None = None, changed: Column | None = None) -> DataFrame:
    """The documents of ``doc``; where ``changed``, with another text (``n_chars`` follows it)."""
    if text is None:
        return rows.select("doc.*")
    rows = rows.select("doc", F.when(changed, text).otherwise(F.col("doc.text")).alias("text"), changed.alias("changed"))
    new = {"text": F.col("text"), "n_chars": F.when(F.col("changed"), F.length("text").cast("long"))
           .otherwise(F.col("doc.n_chars")) if "n_chars" in columns else None}
    return rows.select(*[new[c].alias(c) if new.get(c) is not None else F.col(f"doc.`{c}`").alias(c) for c in columns])
