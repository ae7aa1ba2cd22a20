"""Expenses: per-person breakdowns, shares, pay + expense consolidation,
id -> name lookup and the per-person footprint (C7, C14 core, C16, C17,
A4, A5, A11, J1, J3, J5)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paylens.functions.months import month_number
from paylens.functions.text import legislative, person_key
from paylens.operators.joins import checked_broadcast

EXPENSE_KEYS = ("anyo", "Mes", "llave_senador")


def expense_breakdown(people: DataFrame, *sources: DataFrame, keys=EXPENSE_KEYS,
                      concept: str = "gastos_operacionales", amount: str = "monto",
                      few: bool = False) -> DataFrame:
    """Sum by concept over all expense sources, for a set of person-months (J5 + A4).

    ``people`` holds the key columns.  The sources are unioned (one scan
    each) and summed by (keys, concept); Spark's partial/final aggregation
    does the reference's per-source-then-total two levels.

    The people are joined after the aggregation, so the join sees one row per
    person-month-concept rather than raw rows, whatever share of rows one
    person holds; adaptive execution broadcasts them if they turn out small.
    A caller who knows that they are few (a result page of limited rows) says
    ``few``: then they are broadcast and filter the expense rows before
    anything is shuffled.  Output: keys, Concepto, Monto.
    """
    keys = list(keys)
    cols = keys + [concept, amount]
    union = reduce(lambda a, b: a.unionByName(b), [s.select(*cols) for s in sources])
    who = people.select(*keys).distinct()

    def total(df):
        return df.groupBy(*keys, F.col(concept).alias("Concepto")).agg(F.sum(amount).alias("Monto"))

    if few:
        return total(union.join(F.broadcast(who), on=keys, how="left_semi"))
    return total(union).join(who, on=keys, how="left_semi")


def expense_detail_for(rows: DataFrame, *sources: DataFrame, year_col: str = "anyo",
                       month_col: str = "Mes", names=("Nombres", "Paterno", "Materno"),
                       origin_cols=("origen", "organismo_nombre")) -> DataFrame:
    """C7 for selected result rows: only Senate / Chamber rows have expense
    detail (F14); each is keyed like the detail tables - trimmed name parts
    joined, case kept (X7), month name to number with 1 for unknown (J4) -
    and broken down by concept over all ``sources`` (J5 + A4)."""
    legis = rows.filter(legislative(*[F.col(c) for c in origin_cols]))
    people = legis.select(
        F.col(year_col).cast("int").alias("anyo"),
        month_number(F.col(month_col), default=1, normalize=False).alias("Mes"),
        person_key(*[F.col(n) for n in names], upper=False).alias("llave_senador"))
    return expense_breakdown(people, *sources)


def person_expenses(*sources: DataFrame, year, month, key: str, keys=EXPENSE_KEYS,
                    concept: str = "gastos_operacionales", amount: str = "monto") -> DataFrame:
    """One person-month's expenses by concept, largest first (C7 point lookup).

    Equality filters on the three keys are written once over the union and
    pushed by Catalyst into every source scan; no join is needed.
    """
    y, m, k = keys
    cols = [y, m, k, concept, amount]
    union = reduce(lambda a, b: a.unionByName(b), [s.select(*cols) for s in sources])
    mine = union.filter((F.col(y) == F.lit(year)) & (F.col(m) == F.lit(month)) & (F.col(k) == F.lit(key)))
    return (mine.groupBy(F.col(concept).alias("Concepto")).agg(F.sum(amount).alias("Monto"))
            .orderBy(F.col("Monto").desc_nulls_last(), F.col("Concepto").asc_nulls_last()))


def expense_share(breakdown: DataFrame, *, concept: str = "Concepto", amount: str = "Monto",
                  keys=()) -> DataFrame:
    """Share of each concept in its total, positive amounts only (A11 + F12).

    Without keys the grand total is a scalar subquery over the positive rows;
    Spark reuses the breakdown's exchange for it.  With keys it is a grouped
    total joined back on the keys (both sides one row per key).
    """
    pos = breakdown.filter(F.col(amount) > 0)
    keys = list(keys)
    if not keys:
        total = pos.agg(F.sum(amount)).scalar()
        return pos.select(concept, amount, (F.col(amount) / F.nullif(total, F.lit(0))).alias("share"))
    totals = pos.groupBy(*keys).agg(F.sum(amount).alias("_total"))
    return (pos.join(totals, keys)
            .select(*keys, concept, amount,
                    (F.col(amount) / F.nullif(F.col("_total"), F.lit(0))).alias("share")))


def expense_totals(expenses: DataFrame, keys, amount: str = "monto",
                   out: str = "total_gastos_operacionales") -> DataFrame:
    """Expense total per key (A5); rows with a NULL key are left out."""
    keys = list(keys)
    cond = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    return expenses.filter(cond).groupBy(*keys).agg(F.sum(amount).alias(out))


def pay_with_expenses(pay: DataFrame, expenses: DataFrame, keys, *, pay_amount: str = "dieta",
                      amount: str = "monto") -> DataFrame:
    """Pay rows left-joined to their expense totals, 0 when none, plus the
    monthly total cost (J1 + P9).  Both inputs grow with the data, so this
    is a shuffle join on the keys (AQE may broadcast a small side)."""
    keys = list(keys)
    totals = expense_totals(expenses, keys, amount)
    joined = pay.join(totals, on=keys, how="left")
    total = F.coalesce(F.col("total_gastos_operacionales"), F.lit(0).cast("bigint"))
    return (joined.withColumn("total_gastos_operacionales", total)
            .withColumn("costo_total_mensual", F.col(pay_amount) + F.col("total_gastos_operacionales")))


def latest_names(names: DataFrame, *, key: str, name: str, order) -> DataFrame:
    """One name per id: the one from the latest (year, month) (J3 dedupe).

    ``max_by`` is a partial aggregate, so an id with many rows stays cheap.
    """
    rank = F.struct(*[F.col(c) for c in order])
    return names.groupBy(key).agg(F.max_by(F.col(name), rank).alias(name))


def attach_names(facts: DataFrame, names: DataFrame, *, key: str,
                 bound_by: DataFrame | None = None) -> DataFrame:
    """Left-join an id -> name table (J3); unmatched ids get NULL.

    The name table is broadcast only when it is proven small: by the bytes of
    the files of ``bound_by``, the scan it was derived from, when given.
    Otherwise the join is left to adaptive execution.
    """
    if bound_by is not None:
        names = checked_broadcast(names, bound_by)
    return facts.join(names, on=key, how="left")


def footprint(parts: dict, keys) -> DataFrame:
    """Per person-month totals across several sources (C17).

    ``parts`` maps a kind name to a DataFrame with ``keys`` + ``amount``.
    The sources are stacked in long form (a union: no shuffle) and turned
    wide by one aggregation with a ``sum(when(kind = ...))`` per kind: a
    single shuffle on the keys, combined map-side first, and no n-way join.
    """
    keys = list(keys)
    long = reduce(lambda a, b: a.unionByName(b), [
        df.select(*keys, F.col("amount").cast("bigint").alias("amount"), F.lit(kind).alias("kind"))
        for kind, df in parts.items()])
    wide = long.groupBy(*keys).agg(*[
        F.coalesce(F.sum(F.when(F.col("kind") == kind, F.col("amount"))), F.lit(0)).cast("bigint").alias(kind)
        for kind in parts])
    return wide.withColumn("total", reduce(lambda a, b: a + b, [F.col(k) for k in parts]))
