"""What to fetch or rebuild: coverage gaps and manifest diffs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def coverage_gaps(present: DataFrame, sources: DataFrame, years: tuple[int, int], *,
                  source: str = "source", year: str = "anyo", month: str = "mes") -> DataFrame:
    """(source, year, month) cells with no data yet (R3 + J6).

    The expected matrix is generated per source row with ``sequence`` +
    ``explode`` (no cross join); the cells already present are removed with
    a left anti join on the three keys.
    """
    lo, hi = years
    cells = F.explode(F.sequence(F.lit(lo * 12), F.lit(hi * 12 + 11)))
    expected = (sources.select(source).distinct()
                .select(source, cells.alias("_ym"))
                .select(source, (F.col("_ym") / 12).cast("int").alias(year),
                        (F.col("_ym") % 12 + 1).cast("int").alias(month)))
    have = present.select(source, year, month).distinct()
    return expected.join(have, [source, year, month], "left_anti")


def parse_http_date(c: Column) -> Column:
    """RFC 1123 date ('Wed, 21 Oct 2015 07:28:00 GMT') -> timestamp (UTC), NULL if bad."""
    body = F.regexp_replace(c, r"^\s*\w+,\s*", "")
    return F.try_to_timestamp(body, F.lit("dd MMM yyyy HH:mm:ss z"))


def manifest_diff(local: DataFrame, remote: DataFrame, *, name: str = "name",
                  size: str = "size", modified: str = "last_modified") -> DataFrame:
    """Per file: download, skip or up-to-date.

    ``remote`` is the new manifest (size, RFC 1123 date); ``local`` what is
    on disk (size, modification time as timestamp or RFC 1123 text).
    Unknown or zero remote size -> 'skip'; missing locally, size differs,
    or remote newer -> 'download'; else 'up_to_date'.  A full outer join
    also reports local files the remote no longer lists ('gone').
    """
    r = remote.select(F.col(name), F.col(size).alias("remote_size"),
                      parse_http_date(F.col(modified)).alias("remote_modified"))
    lmod = F.col(modified)
    if dict(local.dtypes).get(modified) == "string":
        lmod = parse_http_date(lmod)
    l_ = local.select(F.col(name), F.col(size).alias("local_size"), lmod.alias("local_modified"))
    j = r.join(l_, name, "full_outer")
    action = (F.when(F.col("remote_size").isNull() & F.col("local_size").isNotNull(), "gone")
              .when(F.coalesce(F.col("remote_size"), F.lit(0)) == 0, "skip")
              .when(F.col("local_size").isNull(), "download")
              .when(F.col("local_size") != F.col("remote_size"), "download")
              .when(F.col("remote_modified").isNotNull()
                    & (F.col("local_modified") < F.col("remote_modified")), "download")
              .otherwise("up_to_date"))
    return j.select(name, "local_size", "remote_size", action.alias("action"))
