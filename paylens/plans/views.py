"""Pay-shaped views over the driver's test tables.

The library operators are written against pay data (person, organisation,
year, month name, amount).  These functions express the test tables in
that shape so every operator runs over whole tables; money columns become
exact integer cents.  Period filters are also given as ranges on the raw
timestamp so Parquet row groups are skipped (pushed filters).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paylens.functions.money import to_cents
from paylens.functions.months import month_name
from paylens.functions.text import audit_full_name
from paylens.operators.joins import checked_broadcast
from paylens.session import table


def month_range(col: str, year: int, month: int):
    """[first day of month, first day of next month) on a timestamp column.

    The bounds are wall-clock (``timestamp_ntz``) literals, so the filter
    means the same in any session time zone and is pushed to the scan.
    """
    start = dt.datetime(year, month, 1)
    end = dt.datetime(year + (month == 12), month % 12 + 1, 1)

    def ntz(d):
        return F.lit(d.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp_ntz")
    return (F.col(col) >= ntz(start)) & (F.col(col) < ntz(end))


def lineitem_jobs(spark: SparkSession, sf_dir: str, year: int | None = None,
                  month: int | None = None) -> DataFrame:
    """lineitem as employment rows: part = person, supplier = organisation."""
    li = table(spark, sf_dir, "lineitem")
    if year is not None and month is not None:
        li = li.filter(month_range("l_shipdate", year, month))
    return li.select(
        F.col("l_partkey").cast("string").alias("nombre_completo"),
        F.col("l_suppkey").alias("organismo"),
        F.col("l_returnflag").alias("Origen"),
        F.year("l_shipdate").alias("anyo"),
        month_name(F.month("l_shipdate")).alias("Mes"),
        to_cents(F.col("l_extendedprice")).alias("sueldo_num"))


def order_pay(spark: SparkSession, sf_dir: str, year: int | None = None,
              month: int | None = None) -> DataFrame:
    """orders joined to their customer and nation, as pay rows."""
    orders = table(spark, sf_dir, "orders")
    if year is not None and month is not None:
        orders = orders.filter(month_range("o_orderdate", year, month))
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey")
    nation = checked_broadcast(table(spark, sf_dir, "nation").select("n_nationkey", "n_name"))
    joined = (orders.join(customer, orders.o_custkey == customer.c_custkey)
              .join(nation, F.col("c_nationkey") == F.col("n_nationkey")))
    return joined.select(
        F.col("n_name").alias("organismo"),
        audit_full_name(F.col("c_name"), F.lit(None), F.lit(None)).alias("nombre_completo"),
        to_cents(F.col("o_totalprice")).alias("sueldo_num"),
        F.col("o_orderstatus").alias("Origen"),
        F.col("o_orderpriority").alias("cargo"),
        F.year("o_orderdate").alias("anyo"),
        month_name(F.month("o_orderdate")).alias("Mes"))


def part_staff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """part as staff rows: brand = organisation, second name word = surname."""
    part = table(spark, sf_dir, "part")
    return part.select(
        F.col("p_brand").alias("organismo"),
        F.element_at(F.split(F.col("p_name"), " "), 2).alias("Paterno"),
        to_cents(F.col("p_retailprice")).alias("sueldo_num"))


def event_pay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as pay rows grouped by event type."""
    ev = table(spark, sf_dir, "events")
    return ev.select(
        F.col("user_id").cast("string").alias("organismo"),
        F.col("event_id").cast("string").alias("nombre"),
        F.col("event_type").alias("estamento"),
        to_cents(F.col("value")).alias("sueldo_num"))


def document_pay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents as pay rows: source = group, length = amount."""
    docs = table(spark, sf_dir, "documents")
    return docs.select(
        F.col("lang").alias("organismo"),
        F.col("doc_id").cast("string").alias("nombre"),
        F.col("source").alias("estamento"),
        F.col("n_chars").alias("sueldo_num"))


def order_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders as searchable pay rows (priority = organisation, status = source)."""
    o = table(spark, sf_dir, "orders")
    return o.select(
        "o_orderkey", "o_custkey", "o_orderdate",
        F.col("o_orderpriority").alias("organismo_nombre"),
        F.year("o_orderdate").alias("anyo"),
        month_name(F.month("o_orderdate")).alias("Mes"),
        F.col("o_orderstatus").alias("origen"),
        to_cents(F.col("o_totalprice")).alias("remuliquida_mensual"))


def part_people(spark: SparkSession, sf_dir: str) -> DataFrame:
    """part as people: first / second name word, brand = organisation, type = role."""
    part = table(spark, sf_dir, "part")
    words = F.split(F.col("p_name"), " ")
    return part.select(
        "p_partkey",
        F.element_at(words, 1).alias("Nombres"),
        F.element_at(words, 2).alias("Paterno"),
        F.lit(None).cast("string").alias("Materno"),
        F.col("p_brand").alias("organismo_nombre"),
        F.col("p_type").alias("cargo"))


def line_expenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem joined to its order: expense rows keyed by (year, month, customer)."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_returnflag", "l_linestatus", "l_extendedprice")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    j = li.join(o, li.l_orderkey == o.o_orderkey)
    return j.select(
        F.year("o_orderdate").alias("anyo"),
        F.month("o_orderdate").alias("Mes"),
        F.col("o_custkey").alias("llave_senador"),
        F.col("l_returnflag").alias("gastos_operacionales"),
        F.col("l_linestatus"),
        to_cents(F.col("l_extendedprice")).alias("monto"))


def money_text(cents) -> "F.Column":
    """Integer cents as published money text: '$ -1.234,56'."""
    mag = F.abs(cents)
    sign = F.when(cents < 0, F.lit("-")).otherwise(F.lit(""))
    whole = F.translate(F.format_number(F.floor(mag / 100), 0), ",", ".")
    frac = F.lpad((mag % 100).cast("string"), 2, "0")
    return F.concat(F.lit("$ "), sign, whole, F.lit(","), frac)
