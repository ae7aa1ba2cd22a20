"""Plan shapes that the scale design relies on, checked on executed plans.

A hot key (a third of all rows) must not change results, must not be
gathered by a window into one task, and derived broadcast sides must be
the small ones.
"""

import os

from pyspark.sql import functions as F

from paylens.operators import audits, search, summary, sync
from paylens.operators.joins import checked_broadcast, folded_link, scan_bytes
from paylens.sources import sinks


def _plan(df):
    """The executed (final adaptive) plan of ``df``."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def _hot_pay(spark, n=3000):
    # a third of the rows belong to one person, spread over a few orgs
    rows = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit("HOT")).otherwise(F.concat(F.lit("P"), F.col("id").cast("string"))).alias("nombre_completo"),
        (F.col("id") % 7).cast("string").alias("organismo"),
        F.lit("Planta").alias("Origen"), F.lit(2024).alias("anyo"), F.lit("Enero").alias("Mes"),
        (F.col("id") * 10).alias("sueldo_num"))
    return rows


def test_multi_employment_hot_key_partial_aggregation(spark):
    df = audits.multi_employment(_hot_pay(spark), 2024, "Enero")
    plan = _plan(df)
    assert "Window" not in plan and "ObjectHashAggregate" in plan and "partial_collect_set" in plan
    top = df.first()
    assert top.nombre_completo == "HOT" and top.num_empleos == 7
    assert top.sueldo_total == sum(i * 10 for i in range(0, 3000, 3))


def test_last_records_uses_aggregate_not_window(spark):
    rows = _hot_pay(spark).withColumn("search_vector", F.col("nombre_completo"))
    df = search.last_records(rows, "nombre_completo", columns=("organismo",), tie=("sueldo_num",))
    plan = _plan(df)
    assert "Window" not in plan and "max_by" in plan
    hot = df.filter(F.col("nombre_completo") == "HOT").first()
    assert hot.organismo == str(2997 % 7)


def test_outlier_statistics_side_is_broadcast(spark):
    rows = _hot_pay(spark).select("organismo", F.col("nombre_completo").alias("nombre"),
                                  F.concat(F.lit("E"), (F.col("sueldo_num") % 5).cast("string")).alias("estamento"),
                                  "sueldo_num", "anyo", "Mes")
    plan = _plan(audits.pay_outliers(rows, stats_floor=0, result_floor=0))
    assert "BroadcastHashJoin" in plan and "Window" not in plan


def test_no_cartesian_products(spark):
    vals = spark.range(1000).select((F.col("id") * 3).alias("x"))
    hist = _plan(summary.histogram(vals, "x"))
    present = spark.createDataFrame([("a", 2024, 1)], "source string, anyo int, mes int")
    gaps = _plan(sync.coverage_gaps(present, present, (2020, 2024)))
    for plan in (hist, gaps):
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_partitioned_writer_balances_a_hot_year(spark, tmp_dir):
    rows = spark.range(6000).select(
        F.lit("Planta").alias("origen"),
        F.when(F.col("id") < 4000, F.lit(2024)).otherwise(F.lit(2023)).alias("anyo"),
        F.concat(F.lit("name"), F.col("id").cast("string")).alias("search_vector"))
    out = os.path.join(tmp_dir, "pay")
    sinks.write_pay_parquet(rows, out, partition_by=("origen", "anyo"), num_files=6)
    hot = os.path.join(out, "origen=Planta", "anyo=2024")
    files = [f for f in os.listdir(hot) if f.endswith(".parquet")]
    assert len(files) >= 3  # the hot year is cut into several ranges
    back = spark.read.parquet(out).filter(F.col("anyo") == 2023)
    plan = _plan(back)
    assert "PartitionFilters: [isnotnull(anyo" in plan and back.count() == 2000


def test_broadcast_is_bounded_by_bytes_without_a_job(spark, tmp_dir):
    src = os.path.join(tmp_dir, "names")
    spark.range(64_000).selectExpr("id % 10 AS k", "CAST(id AS STRING) AS n").repartition(64).write.parquet(src)
    scan = spark.read.parquet(src)
    dedup = scan.groupBy("k").agg(F.max("n").alias("n"))
    jobs = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("broadcast", "planning")
    small = checked_broadcast(dedup, scan)
    large = checked_broadcast(dedup, scan, max_bytes=scan_bytes(scan) - 1)
    assert not jobs.getJobIdsForGroup("broadcast")
    spark.sparkContext.setJobGroup("tests", "tests")
    assert "broadcast" in small._jdf.queryExecution().logical().toString().lower()
    assert large is dedup


def test_bucketed_pay_and_expenses_join_without_shuffle(spark, tmp_dir):
    from paylens.operators.expenses import pay_with_expenses
    keys = ["ano", "mes", "llave_senador"]
    pay = spark.range(400).select(F.lit(2024).alias("ano"), (F.col("id") % 12 + 1).alias("mes"),
                                  (F.col("id") % 37).cast("string").alias("llave_senador"),
                                  F.col("id").alias("dieta"))
    spent = spark.range(3000).select(F.lit(2024).alias("ano"), (F.col("id") % 12 + 1).alias("mes"),
                                     (F.col("id") % 41).cast("string").alias("llave_senador"),
                                     F.lit(1).cast("long").alias("monto"))
    p = sinks.write_bucketed(pay, "t_pay_b", keys, 4, os.path.join(tmp_dir, "pay"))
    s = sinks.write_bucketed(spent, "t_spent_b", keys, 4, os.path.join(tmp_dir, "spent"))
    old = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold",
                                          "spark.sql.adaptive.autoBroadcastJoinThreshold")}
    try:
        for k in old:  # as with tables too large to broadcast
            spark.conf.set(k, "-1")
        out = pay_with_expenses(p, s, keys)
        plan = _plan(out)
    finally:
        for k, v in old.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)
    assert "SortMergeJoin" in plan and "Exchange" not in plan
    expected = {(r.mes, r.llave_senador): r.n for r in
                spent.groupBy("mes", "llave_senador").agg(F.count(F.lit(1)).alias("n")).collect()}
    for r in out.collect():
        assert r.total_gastos_operacionales == expected.get((r.mes, r.llave_senador), 0)


def test_folded_link_gives_one_row_on_request(spark):
    left = spark.createDataFrame([("José",), ("jose",), (" ",)], "who string")
    right = spark.createDataFrame([("JOSE", 2), ("josé", 1)], "name string, id int")
    rows = sorted((r.who, r.n_matches, r.name) for r in folded_link(left, right, "who", "name", one=True).collect())
    assert rows == [(" ", None, None), ("José", 2, "JOSE"), ("jose", 2, "JOSE")]
    assert folded_link(left, right, "who", "name").count() == 5
