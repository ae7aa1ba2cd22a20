"""Summaries of drops merge to what a full scan gives; only changed drops are read."""

import glob

import pytest
from pyspark.sql import functions as F

from paylens.operators import audits, catalogue, partials, summary
from paylens.operators.joins import folded_link, hot_names, spread_folded_link
from paylens.sources import generations, sinks

SCHEMA = ("origen string, anyo int, Mes string, organismo_nombre string, estamento string, "
          "remuliquida_mensual bigint, drop string")


def _rows(drop, n, year=2024, base=500000):
    return [("Planta" if i % 2 else "Contrata", year, "Enero", f"o{i % 3}" if i % 7 else None,
             f"E{i % 2}" if i % 11 else None, base + i * i * 37 if i % 5 else None, drop) for i in range(n)]


def _ingest(spark, lake, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    return generations.commit(df, lake, ("origen", "anyo", "Mes", "drop"), lambda d, columns: sinks.write_pay_parquet(
        d, lake, partition_by=columns, num_files=2, sort_by=None, mode="append"))


def _stats(df):
    return {r[0]: (round(r["promedio"], 4), None if r["desv"] is None else round(r["desv"], 4)) for r in df.collect()}


def _same_as_full(spark, lake, states_path, floor):
    pay, states = generations.read(spark, lake), generations.read(spark, states_path)
    full = audits.group_stats(pay, amount="remuliquida_mensual", floor=floor, min_group=1)
    assert _stats(partials.merged_stats(states, min_group=1)) == _stats(full)
    assert sorted(catalogue.build_catalogue(states).collect()) == sorted(catalogue.build_catalogue(pay).collect())
    one = summary.histogram(pay, "remuliquida_mensual", 7, bounds=partials.merged_bounds(states))
    assert sorted(one.collect()) == sorted(summary.histogram(pay, "remuliquida_mensual", 7).collect())
    return one


def test_adding_a_drop_reads_only_that_drop(spark, tmp_dir):
    lake, states = f"{tmp_dir}/lake", f"{tmp_dir}/states"
    _ingest(spark, lake, _rows("a", 60) + _rows("b", 45, 2023, 300000))
    assert partials.refresh(spark, lake, states) == ["a", "b"]
    assert partials.refresh(spark, lake, states) == []
    _same_as_full(spark, lake, states, 400000)
    _ingest(spark, lake, _rows("c/d e", 80, 2025, 900000))
    # the files of the other drops cannot be read now: nobody may try
    kept = {f: open(f, "rb").read() for d in "ab" for f in glob.glob(f"{lake}/*/*/*/drop={d}/*/*.parquet")}
    assert kept
    for f in kept:
        with open(f, "wb") as out:
            out.write(b"x" * 64)
    assert partials.refresh(spark, lake, states) == ["c/d e"]
    for f, content in kept.items():
        with open(f, "wb") as out:
            out.write(content)
    _same_as_full(spark, lake, states, 400000)


def test_a_replaced_drop_replaces_its_summary(spark, tmp_dir):
    lake, states = f"{tmp_dir}/lake", f"{tmp_dir}/states"
    _ingest(spark, lake, _rows("a", 60) + _rows("b", 45, 1999, 10**12))
    partials.refresh(spark, lake, states)
    _ingest(spark, lake, _rows("b", 30, 2024))
    assert partials.refresh(spark, lake, states) == ["b"]
    _same_as_full(spark, lake, states, 400000)
    # another floor is another measure: all drops are summarised again
    assert partials.refresh(spark, lake, states, floor=600000) == ["a", "b"]
    _same_as_full(spark, lake, states, 600000)
    plain = catalogue.catalogue_job(spark, lake, f"{tmp_dir}/plain")
    merged = catalogue.catalogue_job(spark, lake, f"{tmp_dir}/merged", states, measure={"floor": 600000})
    assert sorted(plain.collect()) == sorted(merged.collect())
    assert partials.refresh(spark, lake, states, floor=600000) == []


def test_a_failing_refresh_keeps_the_summaries(spark, tmp_dir, monkeypatch):
    lake, states = f"{tmp_dir}/lake", f"{tmp_dir}/states"
    _ingest(spark, lake, _rows("a", 60))
    partials.refresh(spark, lake, states)
    before = sorted(generations.read(spark, states).collect(), key=str)
    _ingest(spark, lake, _rows("b", 20))

    def broken(path):
        def write(df, columns):
            raise RuntimeError("disk")
        return write
    with monkeypatch.context() as m:
        m.setattr(partials, "_append", broken)
        with pytest.raises(RuntimeError):
            partials.refresh(spark, lake, states)
    assert sorted(generations.read(spark, states).collect(), key=str) == before
    assert partials.refresh(spark, lake, states) == ["b"]
    _same_as_full(spark, lake, states, 400000)


def test_deviation_of_large_close_amounts_keeps_its_digits(spark):
    # sums of squares would lose all of them; what is left is rounding of the mean at 1e14 (steps of 1/64)
    rows = [("P", 2024, "Enero", "o", "E", 10**14 + i % 5, d) for d in "ab" for i in range(50)]
    states = partials.summarise(spark.createDataFrame(rows, SCHEMA), by=("drop",))
    got = partials.merged_stats(states).first()
    assert got["promedio"] == 10**14 + 2 and abs(got["desv"] - (2 * 100 / 99) ** 0.5) < 1e-3


def test_histogram_with_given_bounds_scans_once(spark, tmp_dir):
    lake, states = f"{tmp_dir}/lake", f"{tmp_dir}/states"
    _ingest(spark, lake, _rows("a", 60))
    partials.refresh(spark, lake, states)
    hist = _same_as_full(spark, lake, states, 400000)
    hist.collect()
    plan = hist._jdf.queryExecution().optimizedPlan().toString()
    # the other relations are the summaries, which have no such column
    assert sum("remuliquida_mensual" in line for line in plan.splitlines() if "Relation [" in line) == 1


def test_summaries_of_no_rows(spark):
    none = partials.summarise(spark.createDataFrame([], SCHEMA))
    assert partials.merged_stats(none).count() == 0 and catalogue.build_catalogue(none).count() <= 1
    assert tuple(partials.merged_bounds(none).first()) == (None, None)


def _named(spark, n):
    who = F.when(F.col("id") % 3 == 0, "José  Núñez").when(F.col("id") % 10 == 1, " ").when(F.col("id") % 10 == 2, None)
    return spark.range(n).select("id", who.otherwise(F.concat(F.lit("P"), F.col("id") % 50)).alias("who"))


@pytest.mark.parametrize("how", ["left", "inner"])
def test_hot_name_gives_the_rows_of_the_plain_link(spark, how):
    left = _named(spark, 3000)
    right = spark.createDataFrame([("JOSE  NUNEZ", 1), ("josé  núñez", 2), ("p7", 3), ("P8", 4), (None, 5), ("", 6)], "name string, k int")

    def rows(link, **more):
        return sorted(map(tuple, link(left, right, "who", "name", how=how, **more).collect()), key=str)
    assert rows(spread_folded_link) == rows(spread_folded_link, parts=1) == rows(folded_link)


def test_hot_name_spreads_over_tasks(spark):
    left = _named(spark, 6000)
    right = spark.createDataFrame([("JOSE  NUNEZ", 1), ("P7", 2)], "name string, k int")
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "16"}
    old = {k: spark.conf.get(k) for k in conf}

    def largest(link):
        return max(r["count"] for r in link(left, right, "who", "name").groupBy(F.spark_partition_id()).count().collect())
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        assert largest(folded_link) >= 2000 and largest(spread_folded_link) < 900
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    with pytest.raises(ValueError):
        spread_folded_link(left, right, "who", "name", how="full")


def test_hot_names_are_few_by_definition(spark):
    keyed = _named(spark, 3000).withColumnRenamed("who", "k")
    hot = {r["k"]: r["_pieces"] for r in hot_names(keyed, "k", 5).collect()}
    assert hot == {"José  Núñez": 2}  # a third of all rows, of 0.85 that have a name
    assert hot_names(keyed.filter("k is null"), "k", 5).count() == 0
