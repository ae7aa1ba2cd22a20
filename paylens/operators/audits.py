"""The four audits over a unified pay view.

Input is any DataFrame with the audit columns (names are parameters);
use :func:`paylens.operators.unify.audit_view` to build it from raw files,
or pass the unified Parquet table.  Every audit filters one period first
(partition pruning when the table is partitioned by year), aggregates with
map-side partial aggregation, and ends in a top-k (``TakeOrderedAndProject``)
with a total tie-break, so results are deterministic.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paylens.functions.money import digits_money, round_to_long
from paylens.functions.text import audit_full_name, fold_text

# Surnames too common to signal anything, excluded by the
# concentration audit (as published, unaccented).
COMMON_SURNAMES = [
    "GONZALEZ", "MUÑOZ", "ROJAS", "DIAZ", "PEREZ",
    "SOTO", "CONTRERAS", "SILVA", "MARTINEZ", "SEPULVEDA",
]


def audit_rows(view: DataFrame) -> DataFrame:
    """The audit view (all text, see ``unify.audit_view``) as audit input:
    upper-cased full name, strict integer year, digits-only pay (X2, X8,
    X11), keeping the other columns."""
    return view.select(
        "Origen", "organismo", "Mes", "estamento", "cargo", "Paterno",
        F.col("Nombres").alias("nombre_raw"),
        audit_full_name(F.col("Nombres"), F.col("Paterno"), F.col("Materno")).alias("nombre_completo"),
        F.col("anyo").try_cast("int").alias("anyo"),
        digits_money(F.col("sueldo")).alias("sueldo_num"))


def _period(df: DataFrame, year, month, year_col: str, month_col: str) -> DataFrame:
    if year is not None:
        col = F.col(year_col)
        if dict(df.dtypes).get(year_col) == "string":
            col = col.try_cast("int")  # text years: junk is no match, not an error
        df = df.filter(col == F.lit(year))
    if month is not None:
        df = df.filter(F.col(month_col) == F.lit(month))
    return df


def multi_employment(df: DataFrame, year=None, month=None, *, person: str = "nombre_completo",
                     org: str = "organismo", kind: str = "Origen", amount: str = "sueldo_num",
                     year_col: str = "anyo", month_col: str = "Mes", limit: int = 100) -> DataFrame:
    """People paid by more than one organisation in the same month (A1 + T1).

    One aggregation keyed by (person, year, month).  The distinct
    organisation set doubles as COUNT DISTINCT (both ignore NULL), so no
    Expand of the input is needed; partial aggregation combines rows on the
    map side, so a person holding a large share of rows arrives at the
    reducer as one small set per map task, bounded by the number of
    organisations.
    """
    base = _period(df, year, month, year_col, month_col)
    orgs = F.array_sort(F.collect_set(org))
    grouped = (base.groupBy(person, year_col, month_col)
               .agg(F.size(orgs).alias("num_empleos"),
                    F.sum(amount).alias("sueldo_total"),
                    orgs.alias("lista_organismos"),
                    F.array_sort(F.collect_set(kind)).alias("tipos_contrato")))
    return (grouped.filter(F.col("num_empleos") > 1)
            .orderBy(F.col("sueldo_total").desc_nulls_last(), F.col(person).asc_nulls_last(),
                     F.col(year_col), F.col(month_col))
            .limit(limit))


def pay_ranking(df: DataFrame, year=None, month=None, *, amount: str = "sueldo_num",
                columns=("organismo", "nombre_completo", "sueldo_num", "Origen", "cargo"),
                tie=("nombre_completo", "organismo"), year_col: str = "anyo",
                month_col: str = "Mes", limit: int = 100) -> DataFrame:
    """Highest single pay amounts of one month (F6 + F7 + T1)."""
    base = _period(df, year, month, year_col, month_col).filter(F.col(amount).isNotNull())
    order = [F.col(amount).desc()] + [F.col(c).asc_nulls_last() for c in tie]
    return base.select(*columns).orderBy(*order).limit(limit)


def surname_concentration(df: DataFrame, year=None, month=None, *, min_count: int = 5,
                          org: str = "organismo", surname: str = "Paterno",
                          amount: str = "sueldo_num", exclude=tuple(COMMON_SURNAMES),
                          year_col: str = "anyo", month_col: str = "Mes",
                          limit: int = 100, fold: bool = False) -> DataFrame:
    """Organisations where one paternal surname repeats at least ``min_count``
    times (F8 + F9 + A2 + T1).  Counts rows, as published.

    ``fold=True`` trims and accent-folds the surname before grouping and
    before the exclusion test, so 'GONZÁLEZ' and ' Gonzalez' are the common
    surname they spell (the published audit compares the raw upper case).
    """
    base = _period(df, year, month, year_col, month_col)
    raw = F.col(surname)
    if fold:
        raw = F.nullif(fold_text(raw, strip=True), F.lit(""))
    upper = F.upper(raw)
    base = base.filter((F.length(raw) > 2) & ~upper.isin(list(exclude)))
    grouped = (base.groupBy(F.col(org), upper.alias("apellido"))
               .agg(F.count(F.lit(1)).alias("cantidad_personas"),
                    F.sum(amount).alias("costo_mensual_total")))
    return (grouped.filter(F.col("cantidad_personas") >= min_count)
            .orderBy(F.col("cantidad_personas").desc(), F.col(org).asc_nulls_last(),
                     F.col("apellido").asc_nulls_last())
            .limit(limit))


def group_stats(df: DataFrame, *, group: str = "estamento", amount: str = "sueldo_num",
                floor=400000, min_group: int = 10) -> DataFrame:
    """Mean and sample deviation per group over amounts above ``floor``,
    for groups with more than ``min_group`` such rows (A3)."""
    return (df.filter(F.col(amount) > F.lit(floor))
            .groupBy(group)
            .agg(F.avg(amount).alias("promedio"), F.stddev_samp(amount).alias("desv"),
                 F.count(F.lit(1)).alias("_n"))
            .filter(F.col("_n") > min_group)
            .drop("_n"))


def pay_outliers(df: DataFrame, year=None, month=None, *, group: str = "estamento",
                 amount: str = "sueldo_num", name: str = "nombre", org: str = "organismo",
                 sigma: float = 3.0, stats_floor=400000, min_group: int = 10,
                 result_floor=2000000, year_col: str = "anyo", month_col: str = "Mes",
                 limit: int = 100, stats: DataFrame | None = None) -> DataFrame:
    """Pay more than ``sigma`` deviations above its group's mean (A3 + J2 + T1).

    The per-group statistics are one row per group.  Adaptive execution
    measures them once they are aggregated: few are broadcast, many are
    shuffle-joined, with a hot group split.  A window over the group would
    instead put every row of a large group into one task.  ``stats`` (group,
    ``promedio``, ``desv``) gives them ready-made, such as merged from summaries
    of the drops (:mod:`paylens.operators.partials`): then the rows are read once.
    """
    base = _period(df, year, month, year_col, month_col).select(org, name, group, amount)
    if stats is None:
        stats = group_stats(base, group=group, amount=amount, floor=stats_floor, min_group=min_group)
    amt = F.col(amount)
    hits = (base.join(stats, on=group, how="inner")
            .filter((amt > F.col("promedio") + F.lit(sigma) * F.col("desv"))
                    & (amt > F.lit(result_floor))))
    out = hits.select(
        F.col(org), F.col(name), F.col(group), amt.alias("sueldo"),
        round_to_long(F.col("promedio")).alias("promedio_estamento"),
        (amt / F.nullif(F.col("promedio"), F.lit(0))).cast("decimal(10,1)").alias("veces_promedio"))
    return (out.orderBy(F.col("veces_promedio").desc_nulls_last(), F.col("sueldo").desc_nulls_last(),
                        F.col(name).asc_nulls_last(), F.col(org).asc_nulls_last())
            .limit(limit))
