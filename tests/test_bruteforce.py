"""Operators against plain-Python brute force on random data with a hot key."""

from collections import defaultdict

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from paylens.functions.months import MONTHS
from paylens.operators import audits, search

people = st.sampled_from(["HOT", "HOT", "HOT", "A", "B", "C"])
rows_strategy = st.lists(st.tuples(people, st.sampled_from(["o1", "o2", "o3", None]),
                                   st.sampled_from(["Planta", "Contrata"]),
                                   st.integers(2023, 2024), st.sampled_from(MONTHS[:3]),
                                   st.one_of(st.none(), st.integers(0, 1000))),
                         min_size=1, max_size=60)


@settings(max_examples=25, deadline=None)
@given(rows_strategy)
def test_multi_employment_matches_bruteforce(spark, rows):
    df = spark.createDataFrame(rows, "nombre_completo string, organismo string, Origen string, "
                                     "anyo int, Mes string, sueldo_num bigint")
    got = {(r.nombre_completo, r.anyo, r.Mes): (r.num_empleos, r.sueldo_total, tuple(r.lista_organismos))
           for r in audits.multi_employment(df, limit=1000).collect()}
    groups = defaultdict(list)
    for p, o, k, y, m, s in rows:
        groups[(p, y, m)].append((o, s))
    want = {}
    for key, vals in groups.items():
        orgs = sorted({o for o, _ in vals if o is not None})
        amounts = [s for _, s in vals if s is not None]
        if len(orgs) > 1:
            want[key] = (len(orgs), sum(amounts) if amounts else None, tuple(orgs))
    assert got == want


@settings(max_examples=25, deadline=None)
@given(st.lists(st.tuples(people, st.integers(2020, 2024), st.sampled_from(MONTHS),
                          st.integers(0, 10**6)), min_size=1, max_size=60, unique_by=lambda r: r[3]))
def test_last_records_matches_bruteforce(spark, rows):
    df = spark.createDataFrame(rows, "who string, anyo int, Mes string, tie bigint")
    got = {r.who: r.tie for r in search.last_records(df, "who", columns=("tie",), tie=("tie",)).collect()}
    best = {}
    for who, y, m, tie in rows:
        rank = (y, MONTHS.index(m) + 1, tie)
        if who not in best or rank > best[who][0]:
            best[who] = (rank, tie)
    assert got == {w: v[1] for w, v in best.items()}


def _sorted(df):
    return sorted(tuple(r) for r in df.collect())


def test_both_join_strategies_agree(spark):
    from paylens.operators import expenses
    people = spark.range(30).select(F.lit(2024).alias("anyo"), (F.col("id") % 3 + 1).cast("int").alias("Mes"),
                                    (F.col("id") % 7).cast("string").alias("llave_senador"))
    src = spark.range(500).select(F.lit(2024).alias("anyo"), (F.col("id") % 4 + 1).cast("int").alias("Mes"),
                                  (F.col("id") % 9).cast("string").alias("llave_senador"),
                                  F.when(F.col("id") % 2 == 0, "Luz").otherwise("Agua").alias("gastos_operacionales"),
                                  F.col("id").alias("monto"))
    small = expenses.expense_breakdown(people, src, few=True)  # broadcast, then aggregate
    large = expenses.expense_breakdown(people, src)  # aggregate first, then join
    assert _sorted(small) == _sorted(large) and small.count() > 0
    names = src.select(F.col("llave_senador"), F.upper("gastos_operacionales").alias("n")).distinct()
    names = names.groupBy("llave_senador").agg(F.max("n").alias("n"))
    rows = src.select(F.col("llave_senador").alias("organismo"), F.col("monto").cast("string").alias("nombre"),
                      F.col("gastos_operacionales").alias("estamento"), F.col("monto").alias("sueldo_num"))

    def results():
        return (_sorted(expenses.attach_names(src, names, key="llave_senador")),
                _sorted(audits.pay_outliers(rows, stats_floor=0, result_floor=0, sigma=1.0)))

    by_size = results()
    thresholds = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    old = {k: spark.conf.get(k, None) for k in thresholds}
    try:
        for k in thresholds:  # as with sides too large to broadcast
            spark.conf.set(k, "-1")
        assert results() == by_size and by_size[1]
    finally:
        for k, v in old.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)
