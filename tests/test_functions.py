"""Scalar expressions against the fixture values and plain-Python specs."""

import unicodedata
from decimal import ROUND_HALF_UP, Decimal, InvalidOperation

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from paylens.functions import money, months, text

# FIXTURES.md money table: input -> (decimal-comma cleaner, digits cleaner); None = NULL
MONEY_CASES = [
    ("$ 1.000,50", 1001, 100050), ("1.000,49", 1000, 100049), ("1.001,5", 1002, 10015),
    ("2.002,5", 2003, 20025), ("1,000,000", None, 1000000), ("-500", 500, 500),
    ("abc", None, None), ("", None, None), ("9.999.999.999", None, 9999999999),
    ("9" * 20, None, None), ("12,", 12, 12), (",5", 1, 5), (None, None, None),
]


def test_money_cleaners(spark):
    df = spark.createDataFrame([(s,) for s, _, _ in MONEY_CASES], "s string")
    got = df.select(money.clean_money(F.col("s")).alias("x1"),
                    money.digits_money(F.col("s")).alias("x2"),
                    money.digits_money_or_zero(F.col("s")).alias("x3")).collect()
    for (s, x1, x2), row in zip(MONEY_CASES, got):
        assert row.x1 == x1, s
        assert row.x2 == x2, s
        assert row.x3 == (x2 if x2 is not None else 0), s


def _spec_clean(s):
    digits = "".join(ch for ch in s if ch.isdigit() and ch.isascii() or ch == ",").replace(",", ".")
    try:
        v = Decimal(digits).quantize(Decimal(1), rounding=ROUND_HALF_UP)
    except (InvalidOperation, ValueError):
        return None
    return int(v) if -2**31 <= v < 2**31 else None


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="0123456789.,$ -ab", max_size=14), min_size=1, max_size=25))
def test_clean_money_matches_spec(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "s string")
    got = [r.x for r in df.select(money.clean_money(F.col("s")).alias("x")).collect()]
    assert got == [_spec_clean(v) for v in values]


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(min_value=0, max_value=2**31 - 1), min_size=1, max_size=30))
def test_format_then_clean_roundtrip(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "n bigint")
    rows = df.select(money.format_clp(F.col("n")).alias("f"),
                     money.clean_money(money.format_clp(F.col("n"))).alias("back")).collect()
    for v, r in zip(values, rows):
        assert r.f == "$ " + f"{v:,}".replace(",", ".")
        assert r.back == v


def test_format_clp_truncates_and_blanks(spark):
    df = spark.createDataFrame([(1234567.9,), (-1234.5,), (None,)], "x double")
    got = [r.f for r in df.select(money.format_clp(F.col("x")).alias("f")).collect()]
    assert got == ["$ 1.234.567", "$ -1.234", ""]


def _nfkd(s):
    if not s:
        return ""
    return unicodedata.normalize("NFKD", s.lower()).encode("ascii", "ignore").decode("ascii")


LATIN = "".join(chr(c) for c in range(0x20, 0x250)) + "ﬁﬂ…™Ⅻ½ñ"


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet=LATIN, max_size=30), min_size=1, max_size=20))
def test_fold_text_matches_nfkd(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "s string")
    got = [r.f for r in df.select(text.fold_text(F.col("s")).alias("f")).collect()]
    assert got == [_nfkd(v) for v in values]


def test_fold_text_decomposed_and_idempotent(spark):
    decomposed = "Muñoz Pérez"
    df = spark.createDataFrame([(decomposed,), ("Muñoz Pérez",), (None,)], "s string")
    got = df.select(text.fold_text(F.col("s")).alias("f"),
                    text.fold_text(text.fold_text(F.col("s"))).alias("ff")).collect()
    assert [r.f for r in got] == ["munoz perez", "munoz perez", ""]
    assert [r.ff for r in got] == [r.f for r in got]


def test_unaccent_lower_folds_only_sixteen_letters(spark):
    df = spark.createDataFrame([("ÁÉÍÓÚ Ñandú çâã",)], "s string")
    assert df.select(text.unaccent_lower(F.col("s"))).first()[0] == "aeiou nandu çâã"


def _spec_key(*parts):
    kept = [str(p).strip().upper() for p in parts if p is not None and str(p).strip()]
    return " ".join(kept).replace("  ", " ").strip()


@settings(max_examples=50, deadline=None)
@given(st.lists(st.tuples(*[st.one_of(st.none(), st.text(alphabet=" abñ", max_size=6))] * 3),
                min_size=1, max_size=20))
def test_person_key_matches_spec(spark, rows):
    df = spark.createDataFrame(rows, "a string, b string, c string")
    got = [r.k for r in df.select(text.person_key(F.col("a"), F.col("b"), F.col("c")).alias("k")).collect()]
    assert got == [_spec_key(*r) for r in rows]


def test_audit_full_name_keeps_separators(spark):
    df = spark.createDataFrame([(" ana ", "soto", None)], "a string, b string, c string")
    assert df.select(text.audit_full_name(F.col("a"), F.col("b"), F.col("c"))).first()[0] == "ANA SOTO "


def test_ellipsis_and_title(spark):
    df = spark.createDataFrame([("x" * 101, "Diputada Ana"), ("short", "diputado  Luis")], "a string, b string")
    got = df.select(text.ellipsis(F.col("a")).alias("e"), text.strip_title(F.col("b")).alias("t")).collect()
    assert got[0].e == "x" * 100 + "..." and got[1].e == "short"
    assert [r.t for r in got] == ["Ana", "Luis"]


def test_months_both_ways_with_defaults(spark):
    df = spark.createDataFrame([(1,), (12,), (13,), (None,)], "m int")
    got = df.select(months.month_name(F.col("m")).alias("n"),
                    months.month_name(F.col("m"), default="Enero").alias("d")).collect()
    assert [r.n for r in got] == ["Enero", "Diciembre", None, None]
    assert [r.d for r in got] == ["Enero", "Diciembre", "Enero", "Enero"]
    names = spark.createDataFrame([("MARZO",), ("marzo",), ("Foo",)], "s string")
    got = names.select(months.month_number(F.col("s"), default=0).alias("n")).collect()
    assert [r.n for r in got] == [3, 3, 0]


@settings(max_examples=40, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet=" \t\n 　ab ", max_size=8)),
                min_size=1, max_size=20))
def test_py_strip_matches_str_strip(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "s string")
    got = [r.x for r in df.select(text.py_strip(F.col("s")).alias("x")).collect()]
    assert got == [None if v is None else v.strip() for v in values]


def test_clean_money_rounds_once(spark):
    df = spark.createDataFrame([("0,4999999",), ("2,5000001",), ("1.234,4999999999",)], "s string")
    assert [r.x for r in df.select(money.clean_money(F.col("s")).alias("x")).collect()] == [0, 3, 1234]


def test_format_clp_exact_for_large_integers(spark):
    df = spark.createDataFrame([(9007199254740993,), (-5,)], "n bigint")
    got = [r.f for r in df.select(money.format_clp(F.col("n")).alias("f")).collect()]
    assert got == ["$ 9.007.199.254.740.993", "$ -5"]


def test_full_fold_of_every_code_point(spark):
    import sys
    import unicodedata

    points = [cp for cp in range(1, sys.maxunicode + 1) if not 0xD800 <= cp <= 0xDFFF]
    chars = spark.createDataFrame([(cp, "x" + chr(cp) + "y") for cp in points], "cp long, s string")
    got = {r.cp: r.f for r in chars.select("cp", text.fold_text(F.col("s")).alias("f")).collect()}
    odd = [cp for cp in points
           if got[cp] != unicodedata.normalize("NFKD", ("x" + chr(cp) + "y").lower()).encode("ascii", "ignore").decode()]
    assert not odd, [hex(cp) for cp in odd[:20]]
    assert spark.range(1).select(text.fold_text(F.lit("𝐀na ⑩ ㎏ ﬁn"))).first()[0] == "Ana 10 kg fin"
