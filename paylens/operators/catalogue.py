"""Catalogue of years and organisations per dataset (C13: A8, S10, S11, A12)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

GLOBAL_ENTRY = "Todas (Búsqueda Global)"
# Years offered when a dataset has no catalogue entry.
DEFAULT_YEARS = [2026, 2025, 2024, 2023, 2022, 2021, 2020]


def build_catalogue(pay: DataFrame, *, dataset: str = "origen", year_col: str = "anyo",
                    org_col: str = "organismo_nombre", global_name: str = GLOBAL_ENTRY) -> DataFrame:
    """One row per dataset plus a global row: years (descending) and
    organisations (ascending), NULLs left out.

    The table is read once, down to its distinct (dataset, year) and (dataset,
    organisation) pairs, combined map-side; a rollup of these pairs gives the
    datasets and the global row.
    """
    year, org = F.col(year_col), F.col(org_col)
    marks = F.array(F.struct(year.alias("y"), F.lit(None).cast("string").alias("o")),
                    F.struct(F.lit(None).cast(pay.schema[year_col].dataType).alias("y"), org.cast("string").alias("o")))
    pairs = (pay.filter(F.col(dataset).isNotNull())
             .select(F.col(dataset).alias("dataset"), F.explode(marks).alias("m"))
             .select("dataset", "m.y", "m.o").distinct())
    both = (pairs.rollup("dataset").agg(F.grouping("dataset").alias("_all"), F.collect_set("y").alias("_y"),
                                        F.collect_set("o").alias("_o"))
            .withColumn("dataset", F.when(F.col("_all") == 1, F.lit(global_name)).otherwise(F.col("dataset"))))
    return both.select("dataset",
                       F.sort_array("_y", asc=False).alias("anios"),
                       F.sort_array("_o").alias("organismos"))


def _lookup(catalogue: DataFrame, dataset: str, col: str, fallback) -> DataFrame:
    """The ``col`` of one dataset's row, or ``fallback`` when the dataset is
    missing: the hit (priority 0) and the default (priority 1) are stacked
    and ``min_by`` keeps the better one - at most two rows, no join."""
    hit = (catalogue.filter(F.col("dataset") == F.lit(dataset))
           .select("dataset", F.col(col).alias("value"), F.lit(0).alias("_pri")))
    default = catalogue.sparkSession.range(1).select(
        F.lit(dataset).alias("dataset"), fallback.alias("value"), F.lit(1).alias("_pri"))
    both = hit.unionByName(default)
    return both.groupBy("dataset").agg(F.min_by("value", "_pri").alias(col))


def available_years(catalogue: DataFrame, dataset: str, default=DEFAULT_YEARS) -> DataFrame:
    """Years of one dataset, or the default list when it is missing."""
    return _lookup(catalogue, dataset, "anios", F.array(*[F.lit(y) for y in default]))


def organizations(catalogue: DataFrame, dataset: str) -> DataFrame:
    """Organisations of one dataset, empty list when missing."""
    return _lookup(catalogue, dataset, "organismos", F.array().cast("array<string>"))


def year_bounds(years: DataFrame, col: str = "anios") -> DataFrame:
    """min / max of the year list and the default (min, max) range."""
    return years.select("dataset", F.array_min(col).alias("min_year"),
                        F.array_max(col).alias("max_year"), F.size(col).alias("n_years"))


def catalogue_job(spark, pay_path: str, out: str, state_path: str | None = None,
                  measure: dict | None = None, **names) -> DataFrame:
    """C13 end to end: the partitioned pay table -> catalogue JSON (S10);
    returns the written catalogue for lookups (S11).  With ``state_path``, the
    folder of the table's summaries, only new and replaced drops are read;
    ``measure`` is the ``amount`` and ``floor`` that these are kept with."""
    from paylens.operators import partials
    from paylens.sources.generations import read, read_or_plain
    from paylens.sources.sinks import write_catalogue

    if state_path is None:
        rows = read_or_plain(spark, pay_path)
    else:
        partials.refresh(spark, pay_path, state_path, **(measure or {}))
        rows = read(spark, state_path)
    write_catalogue(build_catalogue(rows, **names), out)
    return spark.read.schema("dataset string, anios array<int>, organismos array<string>").json(out)
