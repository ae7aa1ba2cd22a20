"""Sinks (S7-S10): partitioned ZSTD Parquet, analyst / report CSV, catalogue JSON."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LATIN1 = "ISO-8859-1"


def write_pay_parquet(df: DataFrame, path: str, partition_by=("origen", "anyo", "Mes"),
                      num_files: int | None = None, sort_by: str | None = "search_vector",
                      max_records_per_file: int = 5_000_000, mode: str = "overwrite",
                      observation=None) -> None:
    """Unified pay rows -> Parquet, ZSTD, partitioned.

    Partitioned by source, year and month: audits read one month, searches
    one year range, so both prune directories before any file is opened.

    Rows are range-partitioned on (partition columns, search vector):
    Spark samples the keys, so every task gets a similar share even when
    one year holds a large part of all rows (that year is simply cut into
    several ranges), each task writes into one or two directories, and
    files come out sorted by the search vector (tight min/max statistics).
    ``num_files`` defaults to ``spark.sql.shuffle.partitions``.  Overwrite
    is dynamic: only the partitions present in ``df`` are replaced.
    An ``Observation`` receives rows written and rows with net / gross pay,
    counted in the write itself (above the range exchange, so the key
    sampling pass does not count them twice).
    """
    cols = list(partition_by)
    n = num_files or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = cols + ([sort_by] if sort_by and sort_by in df.columns else [])
    out = df.repartitionByRange(n, *[F.col(c).asc_nulls_last() for c in order])
    out = out.sortWithinPartitions(*order)
    if observation is not None:
        metrics = [F.count(F.lit(1)).alias("rows_written")]
        metrics += [F.count(c).alias(n) for c, n in (("remuliquida_mensual", "with_net_pay"),
                                                   ("remuneracionbruta_mensual", "with_gross_pay"))
                    if c in df.columns]
        out = out.observe(observation, *metrics)
    (out.write.mode(mode).option("compression", "zstd")
     .option("partitionOverwriteMode", "dynamic")
     .option("maxRecordsPerFile", max_records_per_file)
     .partitionBy(*cols).parquet(path))


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Plain ZSTD Parquet (expense detail and other tables)."""
    df.write.mode(mode).option("compression", "zstd").parquet(path)


def write_analyst_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Comma CSV with header, UTF-8."""
    df.write.mode(mode).option("header", True).csv(path)


def write_report_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """';' CSV with header in Latin-1, for spreadsheet users."""
    (df.write.mode(mode).option("header", True).option("sep", ";")
     .option("encoding", LATIN1).csv(path))


def write_catalogue(catalogue: DataFrame, path: str, mode: str = "overwrite") -> None:
    """The catalogue as JSON lines, one dataset per line."""
    catalogue.write.mode(mode).json(path)


def write_monthly_items(items: DataFrame, path: str, keys=("category", "ano", "mes"),
                        mode: str = "overwrite") -> None:
    """Paged API items stored per (category, year, month).

    The published job merged every page of a month into one document; here
    the items stay rows, written as JSON lines into one folder per month, so
    no month is ever gathered into a single record or task.  Re-running a
    month replaces only that month's folder (dynamic overwrite).
    """
    cols = list(keys)
    # rebalanced by month at run time: a large month is split over many tasks
    # and files, small ones get one
    (items.hint("rebalance", *cols)
     .write.mode(mode).option("partitionOverwriteMode", "dynamic")
     .partitionBy(*cols).json(path))


def write_bucketed(df: DataFrame, name: str, keys, buckets: int, path: str,
                   mode: str = "overwrite") -> DataFrame:
    """Write ``df`` as a bucketed, key-sorted Parquet table at ``path``
    (registered as ``name``) and return it.

    Tables joined or aggregated again and again on the same keys (pay and
    expenses on year, month and person) are written once this way with the
    same bucket count; later aggregations and joins on those keys then run
    without any shuffle, bucket by bucket.
    """
    keys = list(keys)
    (df.write.mode(mode).format("parquet").option("path", path).option("compression", "zstd")
     .bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(name))
    return df.sparkSession.table(name)
