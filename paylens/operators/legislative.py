"""Bulk and legislative ETL as Spark jobs.

The reference walks files one by one in pandas; here each job is one
Spark plan over all input files: one scan per header shape, unions,
aggregations and joins on the person-month key, and a single write.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paylens.functions.money import digits_money_or_zero, whole_number
from paylens.functions.months import month_name
from paylens.functions.text import fold_text, person_key
from paylens.operators import expenses as exp
from paylens.operators.unify import (find_column, non_blank, origin_from_name, pay_rows,
                                     ragged_concat, role_of)
from paylens.sources import generations, readers, sinks

# Literal organisation / role / source names of the
# legislative outputs.
SENATE_ORG = "Senado de la República"
SENATE_ROLE = "Senador(a)"
SENATE_TITLE = "Senador(a) de la República"
SENATE_ORIGIN = "Senado"
CHAMBER_ORG = "Cámara de Diputadas y Diputados"
CHAMBER_ORIGIN = "Cámara de Diputados"
SUPPORT_ROLE = "Personal de Apoyo Parlamentario"
DEPUTY_ROLE = "Diputado(a)"
DEFAULT_STAFF_ROLE = "Funcionario/a"
STAFF_KINDS = {"personal_planta": "Personal de Planta",
               "personal_contrata": "Personal a Contrata",
               "personal_honorarios": "Personal a Honorarios"}

# Column names of the drops and the outputs.
BASE_PAY = ("Nombre", "Cargo", "Sueldo Liquido", "Sueldo Bruto")
APP_COLUMNS = ("organismo_nombre", "anyo", "Mes", "estamento", "Nombres", "Paterno", "Materno",
               "cargo", "remuliquida_mensual", "remuneracionbruta_mensual", "origen",
               "search_vector")
SENATE_EXTRACT = ("ano", "mes", "rut", "llave_senador", "dieta", "deducciones", "saldo",
                  "total_gastos_operacionales", "costo_total_mensual")


# ------------------------------------------------------------------ C12

def drop_id(path: str, root: str | None = None) -> str:
    """What names a drop: its path, without the store's address; below ``root``, if given."""
    plain = re.sub(r"^[a-z][a-z0-9+.-]*:(//[^/]*)?(?=/)", "", path.rstrip("/"))
    return plain.removeprefix(drop_id(root) + "/") if root else plain


def _drop_of_row(root: str | None) -> F.Column:
    """The same of the file a row comes from; a drop can be a folder of parts."""
    plain = F.regexp_replace(readers.plain_path(), r"^[a-z][a-z0-9+.-]*:(//[^/]*)?(?=/)|/part-[^/]*$", "")
    below = drop_id(root) + "/" if root else ""
    return F.when(plain.startswith(below), F.substr(plain, F.lit(len(below) + 1))).otherwise(plain)


def bulk_pay(spark: SparkSession, paths, drops: bool = False, skipped: list | None = None,
             root: str | None = None) -> DataFrame | None:
    """All bulk CSV drops as unified pay rows (C12 without the write).

    A drop is a file, or a folder of parts.  Drops are grouped by header (one
    job for all): one scan per header, whatever the number of drops.  A drop
    that is missing or empty is skipped; ``skipped`` collects (path, reason).
    ``drops`` adds the drop's id as a column: its path, below ``root`` if given.
    """
    skipped = skipped if skipped is not None else []
    paths = list(paths)
    there = [p for _, p in readers.existing_paths(spark, [(p, p) for p in paths])]
    skipped += [(p, "missing") for p in paths if p not in there]
    if not there:
        return None
    heads = readers.headers_of(spark, there, readers.LATIN1)
    frames, read = [], set()
    for head, files in heads.items():
        header = readers.split_header(head, ";")
        raw = readers.read_lenient_csv(spark, [readers.literal_path(f) for f in files], columns=header)
        raw = raw.withColumn("__drop", _drop_of_row(root))
        frames.append(pay_rows(raw, origin_from_name(F.regexp_extract("__drop", "([^/]+)$", 1)),
                               header=header + ["__drop"], keep=("__drop",)))
        read.update(drop_id(re.sub(r"/part-[^/]*$", "", f)) for f in files)
    skipped += [(p, "empty") for p in there if drop_id(p) not in read]
    if not frames:
        return None
    rows = reduce(lambda a, b: a.unionByName(b), frames)
    return rows.withColumnRenamed("__drop", "drop") if drops else rows.drop("__drop")


def ingest_bulk_csv(spark: SparkSession, paths, out: str, num_files: int | None = None,
                    observation=None, skipped: list | None = None, root: str | None = None) -> DataFrame | None:
    """CSV drops -> partitioned ZSTD Parquet; returns the committed table.

    Every drop keeps rows of its own (partition ``drop`` below source, year
    and month): another drop of the same source and month adds to it, the same
    drop ingested again replaces all it had before.  A drop is known by its
    path, below ``root`` if given: publishers use the same file name every
    year.  All drops of a call are committed at once, after the write (see
    :mod:`paylens.sources.generations`): a call that fails changes nothing, and
    a drop that is missing or has no rows now keeps the rows it had and is
    reported in ``skipped``.
    Pass a ``pyspark.sql.Observation`` to get, after the write, the number
    of rows written and how many carried a parsable net / gross amount.
    """
    paths, skipped = list(paths), skipped if skipped is not None else []
    rows = bulk_pay(spark, paths, drops=True, skipped=skipped, root=root)
    if rows is None:
        return generations.read(spark, out)
    done = set(generations.commit(rows, out, ("origen", "anyo", "Mes", "drop"), lambda df, columns: sinks.write_pay_parquet(
        df, out, partition_by=columns, num_files=num_files, observation=observation, mode="append")))
    known = {p for p, _ in skipped}
    skipped += [(p, "empty") for p in paths if p not in known and drop_id(p, root) not in done]
    return generations.read(spark, out)


# ------------------------------------------------------------------ C14

def _key(df: DataFrame) -> F.Column:
    cols = [F.col(c) if c in df.columns else F.lit(None).cast("string")
            for c in ("nombre", "appaterno", "apmaterno")]
    # nameless rows have no key: they match nothing and do not meet on one key
    return F.nullif(person_key(*cols), F.lit(""))


def consolidate_senate(pay: DataFrame, expenses: DataFrame | None):
    """Senate pay + operational expenses -> (extract, app rows, detail) (C14).

    ``pay`` and ``expenses`` are item rows (see ``read_envelopes``).  The
    expense totals per (ano, mes, person key) are a partial aggregation;
    the left join keeps every pay row and fills 0 where nothing was spent.
    """
    pay = pay.withColumn("llave_senador", _key(pay))
    keys = ["ano", "mes", "llave_senador"]
    if expenses is not None:
        expenses = expenses.withColumn("llave_senador", _key(expenses))
        final = exp.pay_with_expenses(pay, expenses, keys)
    else:
        final = (pay.withColumn("total_gastos_operacionales", F.lit(0).cast("bigint"))
                 .withColumn("costo_total_mensual", F.col("dieta") + F.col("total_gastos_operacionales")))
    present = [c for c in SENATE_EXTRACT if c in final.columns]
    extract = final.select(*present).orderBy(*[F.col(c).asc_nulls_last() for c in ("ano", "mes", "llave_senador")])

    def upper_or_blank(c):
        return F.coalesce(F.upper(F.col(c)), F.lit("")) if c in final.columns else F.lit("")

    app = final.select(
        F.lit(SENATE_ORG).alias("organismo_nombre"),
        F.col("ano").cast("int").alias("anyo"),
        month_name(F.col("mes"), default="Enero").alias("Mes"),
        F.lit(SENATE_ROLE).alias("estamento"),
        upper_or_blank("nombre").alias("Nombres"),
        upper_or_blank("appaterno").alias("Paterno"),
        upper_or_blank("apmaterno").alias("Materno"),
        F.lit(SENATE_TITLE).alias("cargo"),
        F.coalesce(F.col("saldo"), F.lit(0)).cast("bigint").alias("remuliquida_mensual"),
        F.coalesce(F.col("costo_total_mensual"), F.lit(0)).cast("bigint").alias("remuneracionbruta_mensual"),
        F.lit(SENATE_ORIGIN).alias("origen"))
    app = app.withColumn("search_vector", fold_text(
        F.concat_ws(" ", "Nombres", "Paterno", "Materno"), strip=True))
    detail = None
    if expenses is not None and "gastos_operacionales" in expenses.columns:
        detail = expenses.select(F.col("ano").alias("anyo"), F.col("mes").alias("Mes"),
                                 "llave_senador", "gastos_operacionales", "monto",
                                 F.lit(SENATE_ORG).alias("organismo_nombre"))
    return extract, app, detail


# ------------------------------------------------------------------ C15 / C16

# A month key in a file name (``2024_03.csv``) or a folder name
# (``period=2024_03/part-0.csv``); the expense drops also carry an id.
# It is the last part of the path, or the folder of a drop written in parts:
# months in names of folders above say nothing.
MONTH_FILE = r"(?:^|[/=])(\d{4})_(\d{2})(?:\.csv)?(?:/part-[^/]*)?$"
ID_MONTH_FILE = r"(?:^|[/=])(\d+)_(\d{4})_(\d{2})(?:\.csv)?(?:/part-[^/]*)?$"


def read_month_files(spark: SparkSession, folder: str) -> list[DataFrame]:
    """Every monthly CSV drop of one folder, one frame per header shape,
    with ``anyo`` / ``Mes_id`` from the path (S6, F15)."""
    return readers.read_keyed_groups(spark, folder, MONTH_FILE, ["anyo", "Mes_id"])


def support_staff(df: DataFrame) -> DataFrame | None:
    """Support staff rows: name, '<role> de <deputy>' and digits-only pay."""
    if "Nombre" not in df.columns:
        return None
    boss = find_column(df.columns, regex=r"(?i)diputad")
    return df.select(
        "anyo", "Mes_id", F.lit(SUPPORT_ROLE).alias("estamento"),
        F.upper(F.col("Nombre")).alias("Nombres"),
        role_of(F.col("Cargo") if "Cargo" in df.columns else F.lit(None).cast("string"),
                F.col(f"`{boss}`") if boss else None).alias("cargo"),
        digits_money_or_zero(F.col("Sueldo") if "Sueldo" in df.columns else F.lit(None)).alias("remuliquida_mensual"),
    ).withColumn("remuneracionbruta_mensual", F.col("remuliquida_mensual"))


def staff(df: DataFrame, role: str) -> DataFrame:
    """Permanent / contract / fee staff with columns found by header words."""
    name = find_column(df.columns, "nombre")
    cargo = find_column(df.columns, "cargo", "función")
    money = find_column(df.columns, "remun", "sueldo", "honorario")
    cols = [F.col("anyo"), F.col("Mes_id"), F.lit(role).alias("estamento")]
    if name:
        cols.append(F.upper(F.col(f"`{name}`")).alias("Nombres"))
    if cargo:
        cols.append(F.col(f"`{cargo}`").alias("cargo"))
    if money:
        pay = digits_money_or_zero(F.col(f"`{money}`"))
        cols += [pay.alias("remuliquida_mensual"), pay.alias("remuneracionbruta_mensual")]
    return df.select(*cols)


def deputies(df: DataFrame) -> DataFrame | None:
    """Deputies' base pay rows (gross and net given as plain numbers, also
    ``1000.0``); None for a drop without its columns."""
    if not set(BASE_PAY) <= set(df.columns):
        return None
    return df.select("anyo", "Mes_id", F.lit(DEPUTY_ROLE).alias("estamento"),
                     F.upper(F.col("Nombre")).alias("Nombres"), F.col("Cargo").alias("cargo"),
                     whole_number(F.col("`Sueldo Liquido`")).alias("remuliquida_mensual"),
                     whole_number(F.col("`Sueldo Bruto`")).alias("remuneracionbruta_mensual"))


def chamber_rows(parts) -> DataFrame:
    """Stack the chamber sources and map them to the app schema (C15 core:
    U3, P8, X14, X5, F11)."""
    df = ragged_concat([p for p in parts if p is not None])
    for col, typ in (("Nombres", "string"), ("cargo", "string"),
                     ("remuliquida_mensual", "bigint"), ("remuneracionbruta_mensual", "bigint")):
        if col not in df.columns:
            df = df.withColumn(col, F.lit(None).cast(typ))
    app = df.select(
        F.lit(CHAMBER_ORG).alias("organismo_nombre"),
        F.col("anyo").cast("int").alias("anyo"),
        month_name(F.col("Mes_id")).alias("Mes"),
        "estamento",
        F.coalesce(F.col("Nombres"), F.lit("")).alias("Nombres"),
        F.lit("").alias("Paterno"), F.lit("").alias("Materno"),
        F.coalesce(F.col("cargo").cast("string"), F.lit(DEFAULT_STAFF_ROLE)).alias("cargo"),
        F.coalesce(F.col("remuliquida_mensual"), F.lit(0)).cast("bigint").alias("remuliquida_mensual"),
        F.coalesce(F.col("remuneracionbruta_mensual"), F.lit(0)).cast("bigint").alias("remuneracionbruta_mensual"),
        F.lit(CHAMBER_ORIGIN).alias("origen"))
    app = app.withColumn("search_vector", fold_text(
        F.concat_ws(" ", "Nombres", "Paterno", "Materno"), strip=True))
    return app.filter(non_blank(F.col("Nombres")))


def consolidate_chamber_frames(support=(), staff_by_role: dict | None = None,
                               base=()) -> DataFrame | None:
    """C15 from DataFrames already read (each with ``anyo`` / ``Mes_id``):
    support-staff frames, ``{role: [staff frames]}``, deputies' base-pay
    frames.  Columns are discovered per frame, then all are stacked."""
    parts = [support_staff(df) for df in support]
    for role, frames in (staff_by_role or {}).items():
        parts += [staff(df, role) for df in frames]
    parts += [deputies(df) for df in base]
    parts = [p for p in parts if p is not None]
    return chamber_rows(parts) if parts else None


def consolidate_chamber(spark: SparkSession, raw_dir: str) -> DataFrame | None:
    """C15 over a folder tree of monthly CSV drops (one scan per header
    shape in each folder)."""
    return consolidate_chamber_frames(
        support=read_month_files(spark, f"{raw_dir}/personal_apoyo"),
        staff_by_role={role: read_month_files(spark, f"{raw_dir}/{sub}")
                       for sub, role in STAFF_KINDS.items()},
        base=read_month_files(spark, f"{raw_dir}/diputados_dieta"))


def chamber_expenses(expenses: DataFrame, names: DataFrame) -> DataFrame:
    """Expense rows named through the deputies' id -> name table.

    ``expenses``: Concepto, Monto, id, anyo, Mes.  ``names``: id, Nombre,
    anyo, Mes.  The latest name per id wins; unknown ids get NULL.
    """
    latest = exp.latest_names(names.withColumn("llave_senador", F.upper(F.col("Nombre"))),
                              key="ID_Diputado", name="llave_senador", order=("anyo", "Mes"))
    named = exp.attach_names(expenses, latest, key="ID_Diputado", bound_by=names)
    return named.select("anyo", "Mes", "llave_senador",
                        F.col("Concepto").alias("gastos_operacionales"),
                        digits_money_or_zero(F.col("Monto")).alias("monto"),
                        F.lit(CHAMBER_ORG).alias("organismo_nombre"))


def read_chamber_expenses(spark: SparkSession, raw_dir: str) -> DataFrame | None:
    """``ID_YYYY_MM.csv`` expense drops + the deputies' monthly lists (C16 scan).
    Without any list every name is NULL; no expense row is lost."""
    exp_frames = [df for df in readers.read_keyed_groups(
        spark, f"{raw_dir}/gastos_operacionales", ID_MONTH_FILE, ["ID_Diputado", "anyo", "Mes"])
        if {"Concepto", "Monto"} <= set(df.columns)]
    name_frames = [df for df in readers.read_keyed_groups(
        spark, f"{raw_dir}/diputados_dieta", MONTH_FILE, ["anyo", "Mes"])
        if {"ID_Diputado", "Nombre"} <= set(df.columns)]
    if not exp_frames:
        return None
    expenses = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True),
                      [df.select("Concepto", "Monto", "ID_Diputado", "anyo", "Mes") for df in exp_frames])
    nobody = spark.createDataFrame([], "ID_Diputado int, Nombre string, anyo int, Mes int")
    names = reduce(lambda a, b: a.unionByName(b),
                   [df.select(F.col("ID_Diputado").try_cast("int").alias("ID_Diputado"), "Nombre",
                              "anyo", "Mes") for df in name_frames] or [nobody])
    return chamber_expenses(expenses, names)


# Item fields of the two Senate endpoints that are consolidated.
SENATE_PAY_ITEM = T.StructType([
    T.StructField("ano", T.IntegerType()), T.StructField("mes", T.IntegerType()),
    T.StructField("rut", T.StringType()), T.StructField("nombre", T.StringType()),
    T.StructField("appaterno", T.StringType()), T.StructField("apmaterno", T.StringType()),
    T.StructField("dieta", T.LongType()), T.StructField("deducciones", T.LongType()),
    T.StructField("saldo", T.LongType())])
SENATE_EXPENSE_ITEM = T.StructType([
    T.StructField("ano", T.IntegerType()), T.StructField("mes", T.IntegerType()),
    T.StructField("nombre", T.StringType()), T.StructField("appaterno", T.StringType()),
    T.StructField("apmaterno", T.StringType()),
    T.StructField("gastos_operacionales", T.StringType()), T.StructField("monto", T.LongType())])


def senate_job(spark: SparkSession, cache_dir: str, out_dir: str,
               pay_endpoint: str = "dietas", expense_endpoint: str = "gastos_operacionales") -> dict:
    """C14 end to end: cached JSON pages of both endpoints
    (``<cache>/<endpoint>/<year>/<file>.json``) -> app rows into the
    partitioned pay table, expense detail as Parquet, analyst extract as CSV.

    Returns the output paths.  Unreadable documents are skipped; a missing
    expense endpoint gives zero expenses.
    """
    pay = readers.read_envelopes(spark, f"{cache_dir}/{pay_endpoint}/*/*.json", SENATE_PAY_ITEM)
    exp_paths = readers.existing_paths(spark, [("e", f"{cache_dir}/{expense_endpoint}")])
    spent = (readers.read_envelopes(spark, f"{cache_dir}/{expense_endpoint}/*/*.json", SENATE_EXPENSE_ITEM)
             if exp_paths else None)
    extract, app, detail = consolidate_senate(pay.drop("source_file"),
                                              spent.drop("source_file") if spent is not None else None)
    outs = {"pay": f"{out_dir}/pay", "detail": f"{out_dir}/senado_gastos_detalle",
            "extract": f"{out_dir}/senadores_consolidado"}
    sinks.write_pay_parquet(app, outs["pay"])
    if detail is not None:
        sinks.write_parquet(detail, outs["detail"])
    sinks.write_analyst_csv(extract, outs["extract"])
    return outs


def chamber_job(spark: SparkSession, raw_dir: str, out_dir: str) -> dict:
    """C15 + C16 end to end: monthly drops -> app rows into the partitioned
    pay table and an analyst CSV; expense drops -> named expense detail."""
    outs = {"pay": f"{out_dir}/pay", "extract": f"{out_dir}/diputados_consolidado",
            "detail": f"{out_dir}/diputados_gastos_detalle"}
    app = consolidate_chamber(spark, raw_dir)
    if app is not None:
        sinks.write_pay_parquet(app, outs["pay"])
        # the CSV is derived from the written rows: the drops are read once
        written = spark.read.parquet(outs["pay"]).filter(F.col("origen") == CHAMBER_ORIGIN)
        sinks.write_analyst_csv(written.select(*app.columns), outs["extract"])
    detail = read_chamber_expenses(spark, raw_dir)
    if detail is not None:
        sinks.write_parquet(detail, outs["detail"])
    return outs
