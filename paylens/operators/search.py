"""Person search, latest record, profile disambiguation.

F2-F5 become one conjunctive ``Column`` built on the driver from the
inputs; Catalyst pushes it through the union of sources into each Parquet
scan (``LIKE '%w%'`` / ``contains`` appear as data filters, the year range
prunes ``anyo`` partitions).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paylens.functions.months import month_number
from paylens.functions.text import py_strip, search_words

# Columns a search returns, in the published order.
SEARCH_COLUMNS = (
    "organismo_nombre", "anyo", "Mes", "estamento", "Nombres", "Paterno", "Materno",
    "cargo", "remuliquida_mensual", "remuneracionbruta_mensual", "origen",
)
ALL_MONTHS = "Todos"


def union_sources(frames) -> DataFrame:
    """UNION ALL of same-shaped sources (U1); the filter is written once."""
    return reduce(lambda a, b: a.unionByName(b), frames)


def name_condition(person: str | None, vector: str | Column = "search_vector") -> Column | None:
    """AND of ``contains(word)`` for every folded word of the typed name.

    ``vector`` is a stored column (name) or an expression computed on the
    fly (e.g. a fold of whole document text).  An expression is evaluated
    once per row and bound to a lambda variable, so several words do not
    fold the text several times.
    """
    words = search_words(person)
    if not words:
        return None
    if isinstance(vector, str):
        col = F.col(vector)
        return reduce(lambda a, b: a & b, [col.contains(w) for w in words])
    return F.transform(F.array(vector),
                       lambda v: reduce(lambda a, b: a & b, [v.contains(w) for w in words]))[0]


def search_condition(*, organization=None, years=None, month=None, person=None,
                     vector: str | Column = "search_vector", org_col: str = "organismo_nombre",
                     year_col: str = "anyo", month_col: str = "Mes") -> Column:
    """The conjunctive filter of a search (F2, F3, F4, F5); TRUE when empty."""
    conds = []
    if organization:
        conds.append(F.col(org_col) == F.lit(organization))
    name = name_condition(person, vector)
    if name is not None:
        conds.append(name)
    if years is not None:
        start, end = years
        if start and end:
            try:
                lo, hi = int(start), int(end)
            except (TypeError, ValueError) as exc:
                raise ValueError(f"year bounds must be numeric: {years!r}") from exc
            conds.append(F.col(year_col).between(lo, hi))
    if month and month != ALL_MONTHS:
        conds.append(F.col(month_col) == F.lit(month))
    return reduce(lambda a, b: a & b, conds) if conds else F.lit(True)


def search(pay: DataFrame, *, organization=None, years=None, month=None, person=None,
           limit: int | None = 500, columns=SEARCH_COLUMNS, order=None,
           vector: str | Column = "search_vector", org_col: str = "organismo_nombre",
           year_col: str = "anyo", month_col: str = "Mes") -> DataFrame:
    """Filtered rows, at most ``limit`` (C1 = F2-F5 + U1 + T2).

    The limit is taken in a total order (``order``, default: the returned
    columns) so the same rows come back on every run.
    """
    cond = search_condition(organization=organization, years=years, month=month,
                            person=person, vector=vector, org_col=org_col,
                            year_col=year_col, month_col=month_col)
    rows = pay.filter(cond).select(*columns)
    if limit is None:
        return rows
    keys = list(order) if order else list(columns)
    return rows.orderBy(*[F.col(c).asc_nulls_last() for c in keys]).limit(limit)


def _latest_order(year_col: str, month_col: str, tie) -> list[Column]:
    mnum = month_number(F.col(month_col), default=0)
    return ([F.col(year_col).desc_nulls_last(), mnum.desc()]
            + [F.col(c).desc_nulls_last() for c in tie])


def last_record(pay: DataFrame, person: str | None, *, vector: str | Column = "search_vector",
                columns=("anyo", "Mes", "organismo_nombre", "origen"),
                year_col: str = "anyo", month_col: str = "Mes", tie=()) -> DataFrame:
    """The latest row matching the name, ignoring date filters.

    Latest = highest year, then month, then ``tie``.  A blank name gives
    no rows.
    """
    cond = name_condition(person, vector)
    if cond is None:
        return pay.select(*columns).limit(0)
    rows = pay.filter(cond)
    return (rows.orderBy(*_latest_order(year_col, month_col, tie))
            .select(*columns).limit(1))


def search_or_last_record(pay: DataFrame, *, person: str, limit: int = 500, last: dict | None = None, **filters):
    """The explorer's flow: the filtered search, and when it finds nothing,
    the person's latest record ignoring the date filters (C1 then C2).

    Returns ``(rows, last)``; ``last`` is None when the search found rows.
    The emptiness test takes at most one row (``limit(1)``).  ``last`` holds
    options of :func:`last_record`; column options of the search hold for both.
    """
    rows = search(pay, person=person, limit=limit, **filters)
    if rows.limit(1).count() > 0:
        return rows, None
    shared = {k: v for k, v in filters.items() if k in ("vector", "year_col", "month_col")}
    return rows, last_record(pay, person, **{**shared, **(last or {})})


def last_records(pay: DataFrame, keys, *, columns=("anyo", "Mes", "organismo_nombre", "origen"),
                 year_col: str = "anyo", month_col: str = "Mes", tie=()) -> DataFrame:
    """Latest row per person key, for everyone at once.

    ``max_by`` over a struct of the ordering keys is a plain aggregate with
    map-side partial aggregation: a person with very many rows reaches the
    reducer as one candidate per map task, unlike a window that would sort
    all of that person's rows in one task.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    mnum = month_number(F.col(month_col), default=0)
    rank = F.struct(F.col(year_col), mnum, *[F.col(c) for c in tie])
    payload = F.struct(*[F.col(c) for c in columns])
    best = pay.groupBy(*keys).agg(F.max_by(payload, rank).alias("_best"))
    return best.select(*keys, *[F.col("_best")[c].alias(c) for c in columns])


PROFILE_KEYS = ("Nombres", "Paterno", "Materno")


def _profile_key(c: str) -> Column:
    return py_strip(F.coalesce(F.col(c).cast("string"), F.lit("")))


def profiles(result: DataFrame, *, keys=PROFILE_KEYS, org: str = "organismo_nombre",
             role: str = "cargo", sep: str = " | ") -> DataFrame:
    """Distinct people in a result: organisations and roles joined.

    Name parts are trimmed with NULL as ''.  The joined lists are sorted
    (distributed rows have no "first seen" order).
    """
    keyed = result.select(*[_profile_key(k).alias(k) for k in keys], org, role)
    return (keyed.groupBy(*keys)
            .agg(F.array_join(F.array_sort(F.collect_set(F.col(org).cast("string"))), sep).alias(org),
                 F.array_join(F.array_sort(F.collect_set(F.col(role).cast("string"))), sep).alias(role)))


def select_profile(result: DataFrame, profile: dict, *, keys=PROFILE_KEYS) -> DataFrame:
    """Rows of the result that belong to one chosen profile."""
    cond = reduce(lambda a, b: a & b,
                  [_profile_key(k) == F.lit(profile.get(k) or "") for k in keys])
    return result.filter(cond)


def result_flags(result: DataFrame, limit: int, *, keys=PROFILE_KEYS) -> DataFrame:
    """One row: number of distinct profiles, ambiguity and truncation (A10).

    ``result`` is the unlimited result; it is truncated when it has more rows
    than ``limit`` shows.
    """
    prof = F.struct(*[_profile_key(k) for k in keys])
    return (result.agg(F.count_distinct(prof).alias("n_profiles"), F.count(F.lit(1)).alias("n_rows"))
            .select("n_profiles", "n_rows",
                    (F.col("n_profiles") > 1).alias("ambiguous"),
                    (F.col("n_rows") > F.lit(limit)).alias("truncated")))
