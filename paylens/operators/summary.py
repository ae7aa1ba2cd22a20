"""Summaries of a result: KPIs, display table, histogram, top pay."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paylens.functions.money import format_clp
from paylens.functions.months import month_number
from paylens.functions.text import ellipsis
from paylens.operators.unify import ordered_columns

# Money columns, display order and labels of the tables shown.
MONEY_COLUMNS = ("remuliquida_mensual", "remuneracionbruta_mensual")
DISPLAY_ORDER = (
    "anyo", "Mes", "Nombres", "Paterno", "Materno", "remuneracionbruta_mensual",
    "remuliquida_mensual", "organismo_nombre", "cargo", "estamento", "origen",
)
HIDDEN = ("mes_num", "search_vector")


def amount_column(df: DataFrame) -> str:
    """Net pay when present, else gross pay."""
    return "remuliquida_mensual" if "remuliquida_mensual" in df.columns else "remuneracionbruta_mensual"


def kpis(df: DataFrame, amount: str) -> DataFrame:
    """One row: record count, total, mean, maximum and the total's label.

    A single global aggregate: partial per task, one final row.
    """
    agg = df.agg(F.count(F.lit(1)).alias("registros"), F.sum(amount).alias("gasto_total"),
                 F.avg(amount).alias("promedio"), F.max(amount).alias("maximo"))
    label = (F.when(F.col("registros") == 1, F.lit("Gasto Total (Mes)"))
             .otherwise(F.lit("Gasto Total (Acumulado)")))
    return agg.select("registros", "gasto_total", "promedio", "maximo",
                      label.alias("etiqueta_total"),
                      format_clp(F.col("gasto_total")).alias("gasto_total_txt"),
                      format_clp(F.col("promedio")).alias("promedio_txt"),
                      format_clp(F.col("maximo")).alias("maximo_txt"))


def with_month_number(df: DataFrame, month_col: str = "Mes") -> DataFrame:
    """Add ``mes_num`` from the (capitalised) month name; unknown -> 0."""
    return df.withColumn("mes_num", month_number(F.col(month_col), default=0))


def chronological(df: DataFrame, year_col: str = "anyo", month_col: str = "Mes") -> DataFrame:
    """Newest first: year then month number, both descending (T4)."""
    return with_month_number(df, month_col).orderBy(F.col(year_col).desc_nulls_last(),
                                                    F.col("mes_num").desc())


def display_table(df: DataFrame, order=DISPLAY_ORDER, hidden=HIDDEN,
                  money=MONEY_COLUMNS) -> DataFrame:
    """Known columns first in display order, then the rest; helper columns
    hidden; money as '$ 1.234.567' text (P6, X6)."""
    out = ordered_columns(df, order, hidden)
    return out.withColumns({c: format_clp(F.col(c)) for c in money if c in out.columns})


def histogram(df: DataFrame, amount: str, bins: int = 20, bounds: DataFrame | None = None) -> DataFrame:
    """Equal-width bins between the global min and max.

    The two bounds are scalar subqueries over one global aggregate (partial
    min/max per task), so planning runs no job; the binning is then a map-side
    expression followed by a partial count per bin.  No window over the whole
    table, no cross join.  Bin = floor(bins * (x - lo) / (hi - lo)) + 1, the
    maximum falls in the last bin, and lo = hi puts everything in bin 1.
    ``bounds``, one row (lo, hi) of just these rows, spares the first of the two
    scans: ``partials.merged_bounds`` has it from the summaries of the drops.
    """
    vals = df.select(F.col(amount).alias("x")).filter(F.col("x").isNotNull())
    if bounds is None:
        bounds = vals.agg(F.min("x").alias("lo"), F.max("x").alias("hi"))
    pair = bounds.select(F.struct("lo", "hi")).scalar()
    lo, hi = pair["lo"], pair["hi"]
    raw = F.floor((F.lit(bins) * (F.col("x") - lo)) / F.nullif(hi - lo, F.lit(0))) + 1
    # least() skips NULL, so the lo = hi case is defaulted before clamping
    bucket = F.least(F.coalesce(raw, F.lit(1)), F.lit(bins))
    return (vals.groupBy(bucket.cast("int").alias("bin"))
            .agg(F.count(F.lit(1)).alias("n"), F.min("x").alias("bin_min"), F.max("x").alias("bin_max")))


def top_pay(df: DataFrame, amount: str, n: int = 10, *, tie=("Nombres", "Paterno"),
            labels=None) -> DataFrame:
    """The n largest amounts, role text cut at 100 characters, renamed and
    formatted (T5, X9, P5)."""
    labels = labels or {"Nombres": "Nombre", "Paterno": "Apellido",
                        "cargo": "Cargo / Función", amount: "Sueldo"}
    order = [F.col(amount).desc_nulls_last()] + [F.col(c).asc_nulls_last() for c in tie if c in df.columns]
    top = df.orderBy(*order).limit(n)
    if "cargo" in top.columns:
        top = top.withColumn("cargo", ellipsis(F.col("cargo").cast("string"), 100))
    keep = [c for c in labels if c in top.columns]
    out = top.select(*[F.col(c).alias(labels[c]) for c in keep])
    if "Sueldo" in out.columns:
        out = out.withColumn("Sueldo", format_clp(F.col("Sueldo")))
    return out
