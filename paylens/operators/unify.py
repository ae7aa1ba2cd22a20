"""Schema unification of differently shaped sources.

Column resolution happens on the driver against ``df.columns`` (metadata
only); the result is one ``select`` per source, so Spark still prunes and
pushes filters into each scan.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paylens.functions.money import clean_money
from paylens.functions.text import search_vector

# Target column -> source header candidates, first present
# wins (bulk ingest mapping).
INGEST_MAPPING = {
    "organismo_nombre": ["organismo_nombre", "Organismo", "Institucion"],
    "anyo": ["anyo", "Año", "Year"],
    "Mes": ["Mes", "mes", "Month"],
    "estamento": ["Tipo Estamento", "tipo_calificacionp", "estamento",
                  "Calificacion Profesional", "Tipo Calificacion Profesional"],
    "Nombres": ["Nombres", "nombres", "Nombre"],
    "Paterno": ["Paterno", "paterno", "Apellido Paterno"],
    "Materno": ["Materno", "materno", "Apellido Materno"],
    "cargo": ["Tipo cargo", "descripcion_funcion", "Cargo", "Funcion", "Grado EUS"],
    "remuliquida_mensual": ["remuliquida_mensual", "remuneracionbruta",
                            "Sueldo Liquido", "Honorario Bruto"],
    "remuneracionbruta_mensual": ["remuneracionbruta_mensual", "remuneracionbruta",
                                  "Sueldo Bruto"],
}

# Target column -> candidates for the audit view.
AUDIT_MAPPING = {
    "Nombres": ["Nombres", "nombres", "Nombre"],
    "Paterno": ["Paterno", "paterno", "Apellido Paterno"],
    "Materno": ["Materno", "materno", "Apellido Materno"],
    "anyo": ["anyo", "Año", "Year"],
    "Mes": ["Mes", "mes", "Month"],
    "organismo": ["organismo_nombre", "Organismo", "Institucion"],
    "sueldo": ["remuliquida_mensual", "remuneracionbruta", "Sueldo Liquido", "Honorario Bruto"],
    "estamento": ["Tipo Estamento", "tipo_calificacionp", "estamento", "Calificacion Profesional"],
    "cargo": ["Tipo cargo", "descripcion_funcion", "Cargo", "Funcion"],
}

# File-name fragment -> source tag, checked in this order.
ORIGIN_RULES = [("Contratohonorarios", "Honorarios"), ("Contrata", "Contrata"),
                ("Planta", "Planta")]
UNKNOWN_ORIGIN = "Desconocido"


def resolve(columns, candidates) -> str | None:
    """First candidate that is an existing column (exact, case-sensitive)."""
    present = set(columns)
    return next((c for c in candidates if c in present), None)


def unify(raw: DataFrame, mapping=INGEST_MAPPING, cast: dict | None = None,
          header=None, keep=()) -> DataFrame:
    """One column per target: the first present candidate, else NULL.

    ``header`` is the file's real header (from :func:`read_header`) when it
    differs from ``raw.columns``: Spark makes names that differ only in case
    unique, while candidates match case-sensitively, so the match is made
    on the real names and the column taken by position.
    ``cast`` optionally types targets (missing ones become typed NULLs);
    ``keep`` names extra columns passed through unchanged.
    """
    cast = cast or {}
    header = list(header) if header is not None else list(raw.columns)
    cols = []
    for target, candidates in mapping.items():
        found = resolve(header, candidates)
        if found is not None:
            found = raw.columns[header.index(found)]
        col = F.col(f"`{found}`") if found else F.lit(None).cast(cast.get(target, "string"))
        if found and target in cast:
            col = col.cast(cast[target])
        cols.append(col.alias(target))
    return raw.select(*cols, *keep)


def origin_from_name(name: Column) -> Column:
    """Source tag from a file name or path."""
    expr = None
    for fragment, tag in ORIGIN_RULES:
        cond = name.contains(fragment)
        expr = F.when(cond, F.lit(tag)) if expr is None else expr.when(cond, F.lit(tag))
    return expr.otherwise(F.lit(UNKNOWN_ORIGIN))


def origin_for(name: str) -> str:
    """Driver-side twin of :func:`origin_from_name` for a known file name."""
    return next((tag for frag, tag in ORIGIN_RULES if frag in name), UNKNOWN_ORIGIN)


def pay_rows(raw: DataFrame, origin: Column | str, full_fold: bool = True,
             header=None, keep=()) -> DataFrame:
    """Raw bulk rows -> unified pay rows (C12 core: P1, X1, X11, X5, P3, F1).

    Money through the decimal-comma cleaner, year through a strict
    ``try_cast``, rows outside 2000..2050 (or without a year) dropped.
    The search vector uses the same full fold as the query side, so every
    accented letter matches its base letter; ``full_fold=False`` gives the
    published 16-letter fold instead.  ``keep`` names raw columns carried along.
    """
    kept, keep = tuple(keep), tuple(keep)
    if not isinstance(origin, str):
        # an expression over the raw row (e.g. on the file name): evaluate
        # it before the projection drops the raw columns
        raw = raw.withColumn("__origen", origin)
        header = (list(header) + ["__origen"]) if header is not None else None
        keep, origin = (*keep, "__origen"), F.col("__origen")
    u = unify(raw, INGEST_MAPPING, header=header, keep=keep)
    year = F.col("anyo").try_cast("int")
    u = u.withColumns({
        "anyo": year,
        "remuliquida_mensual": clean_money(F.col("remuliquida_mensual")),
        "remuneracionbruta_mensual": clean_money(F.col("remuneracionbruta_mensual")),
    })
    origin_col = F.lit(origin) if isinstance(origin, str) else origin
    u = u.withColumn("search_vector", search_vector(F.col("Nombres"), F.col("Paterno"),
                                                    F.col("Materno"), full_fold=full_fold))
    u = u.withColumn("origen", origin_col).drop(*[c for c in keep if c not in kept])
    return u.filter(F.col("anyo").between(2000, 2050))


def audit_view(sources) -> DataFrame:
    """UNION ALL of ``(name, raw DataFrame[, header])`` sources mapped to the audit
    columns, tagged with ``Origen`` (P2 + P3 + U2).  All targets are text,
    so differently typed sources union cleanly under ANSI rules."""
    frames = []
    for source in sources:
        name, raw = source[0], source[1]
        header = source[2] if len(source) > 2 else None
        u = unify(raw, AUDIT_MAPPING, cast={k: "string" for k in AUDIT_MAPPING}, header=header)
        frames.append(u.select(F.lit(name).alias("Origen"), *AUDIT_MAPPING))
    return reduce(lambda a, b: a.unionByName(b), frames)


def ragged_concat(frames) -> DataFrame:
    """Stack frames with different column sets; missing columns are NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def with_defaults(df: DataFrame, defaults: dict) -> DataFrame:
    """Add missing columns and fill NULLs with per-column defaults."""
    for col, value in defaults.items():
        if col not in df.columns:
            df = df.withColumn(col, F.lit(value))
        else:
            df = df.withColumn(col, F.coalesce(F.col(col), F.lit(value)))
    return df


def role_of(role: Column, boss: Column | None, role_default: str = "Asesor",
            boss_default: str = "Diputado") -> Column:
    """'<role> de <boss>' with defaults for missing parts (P10)."""
    boss = boss if boss is not None else F.lit(None).cast("string")
    return F.concat(F.coalesce(role, F.lit(role_default)), F.lit(" de "),
                    F.coalesce(boss, F.lit(boss_default)))


def non_blank(c: Column) -> Column:
    """Rows whose name is not empty after trimming."""
    return F.trim(F.coalesce(c, F.lit(""))) != F.lit("")


def clean_headers(df: DataFrame) -> DataFrame:
    """Strip header names and turn newlines into spaces."""
    return df.toDF(*[str(c).strip().replace("\n", " ") for c in df.columns])


def find_column(columns, *needles, regex: str | None = None) -> str | None:
    """First header containing any needle (case-insensitive), or matching
    ``regex`` (P7).  Driver-side, on the schema only."""
    for c in columns:
        low = str(c).lower()
        if regex is not None and re.search(regex, str(c)):
            return c
        if needles and any(n in low for n in needles):
            return c
    return None


def ordered_columns(df: DataFrame, order, hidden=()) -> DataFrame:
    """Known columns in the given order, then the rest, minus hidden."""
    rank = {name: k for k, name in enumerate(order)}
    shown = [c for c in df.columns if c in rank or c not in hidden]
    # sorted() is stable: columns outside the order keep their places after it
    return df.select(*sorted(shown, key=lambda c: rank.get(c, len(rank))))
