"""Mergeable summaries of a pay table, kept per drop.

A summary has a row for each (source, year, month, organisation, role group) of
a drop: counts, bounds, and the moments of the amounts above a floor.  Catalogue,
group statistics and histogram bounds are all rollups of these rows, so they need
no scan of the pay table; and when drops are added or replaced, only those are
read again.

Summaries are a table of committed generations themselves.  Each row names the
generation of the pay table that it was computed from, so the difference of the
two manifests (R4) says which drops are stale, whatever happened in between.  The
driver handles names of drops, never rows of pay.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paylens.sources import generations

KEYS = ("origen", "anyo", "Mes", "organismo_nombre", "estamento")
AMOUNT = "remuliquida_mensual"


def summarise(rows: DataFrame, *, by=(), amount: str = AMOUNT, floor=400000) -> DataFrame:
    """One row per ``by`` and KEYS: ``n_rows``, the bounds ``low`` and ``high`` of
    all amounts, and ``n``, ``total`` and ``m2`` (squared deviations from the
    mean) of those above ``floor``.  NULL amounts count in ``n_rows`` alone."""
    above = F.when(F.col(amount) > F.lit(floor), F.col(amount))
    return rows.groupBy(*by, *KEYS).agg(
        F.count(F.lit(1)).alias("n_rows"), F.min(amount).alias("low"), F.max(amount).alias("high"),
        F.count(above).alias("n"), F.sum(above).alias("total"),
        (F.var_pop(above) * F.count(above)).alias("m2"))


def stale_drops(spark: SparkSession, pay_path: str, state_path: str, measure: str) -> list[str]:
    """Drops of the pay table that have no summary, one of an earlier
    generation, or one of another measure (amount and floor)."""
    states = generations.read(spark, state_path)
    held = set() if states is None else {
        (r["drop"], r["source"]) for r in
        states.filter(F.col("measure") == F.lit(measure)).select("drop", "source").distinct().collect()}
    return sorted(d for d, g in generations.committed(spark, pay_path).items() if (d, g) not in held)


def refresh(spark: SparkSession, pay_path: str, state_path: str, *, amount: str = AMOUNT, floor=400000) -> list[str]:
    """Bring the summaries of a pay table (of generations) up to date and return
    the drops that were read: those that are new or replaced, and no others.
    A run that fails leaves the summaries as they were; the next one resumes."""
    measure = f"{amount} > {floor}"
    stale = stale_drops(spark, pay_path, state_path, measure)
    if not stale:
        return []
    rows = (generations.read(spark, pay_path, keep_generation=True).filter(F.col("drop").isin(stale))
            .withColumnRenamed(generations.GENERATION, "source"))
    states = summarise(rows, by=("drop", "source"), amount=amount, floor=floor).withColumn("measure", F.lit(measure))
    return generations.commit(states, state_path, ("drop",), _append(state_path))


def _append(path: str):
    def write(df: DataFrame, columns: list[str]) -> None:
        (df.hint("rebalance", *columns).write.mode("append").option("compression", "zstd")
         .partitionBy(*columns).parquet(path))
    return write


def merged_stats(states: DataFrame, *, group: str = "estamento", min_group: int = 10) -> DataFrame:
    """Mean and sample deviation per group from summaries, as
    :func:`paylens.operators.audits.group_stats` has them from rows (A3).

    Deviations add up as those within each summary plus those of its mean from
    the group's, so no difference of large sums is taken.
    """
    some = states.filter(F.col("n") > 0).select(F.col(group).alias("_g"), "n", F.col("total").cast("double").alias("total"), "m2")
    whole = (states.filter(F.col("n") > 0).groupBy(group)
             .agg(F.sum("n").alias("_n"), (F.sum("total") / F.sum("n")).cast("double").alias("promedio"))
             .filter(F.col("_n") > min_group))
    both = some.join(whole, F.col("_g").eqNullSafe(F.col(group)))
    apart = F.col("m2") + F.col("n") * F.pow(F.col("total") / F.col("n") - F.col("promedio"), 2)
    return (both.groupBy(group, "promedio", "_n").agg(F.sum(apart).alias("_m2"))
            .select(group, "promedio", F.sqrt(F.col("_m2") / F.nullif(F.col("_n") - 1, F.lit(0))).alias("desv")))


def merged_bounds(states: DataFrame) -> DataFrame:
    """One row (lo, hi): the least and greatest amount of all summarised rows."""
    return states.agg(F.min("low").alias("lo"), F.max("high").alias("hi"))
