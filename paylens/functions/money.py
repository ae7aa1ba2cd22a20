"""Money parsing and formatting.

All expressions are ANSI-safe: ``try_cast`` everywhere a bad string could
appear, so a dirty row yields NULL instead of failing the job.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def clean_money(c: Column) -> Column:
    """'$ 1.000,50' -> 1001 (INT).

    Keep digits and commas, read the comma as the decimal point, round
    half away from zero, and give NULL for anything that is not one number
    or does not fit in 32 bits.  The sign is dropped with the other
    characters.
    """
    digits = F.regexp_replace(c.cast("string"), r"[^0-9,]", "")
    as_decimal = F.replace(digits, F.lit(","), F.lit(".")).try_cast("decimal(38,18)")
    return F.round(as_decimal, 0).try_cast("int")


def digits_money(c: Column) -> Column:
    """'$ 1.000,50' -> 100050 (BIGINT): every non-digit removed."""
    return F.regexp_replace(c.cast("string"), r"[^0-9]", "").try_cast("bigint")


def digits_money_or_zero(c: Column) -> Column:
    """digits_money with NULL / empty / non-numeric -> 0."""
    return F.coalesce(digits_money(c), F.lit(0).cast("bigint"))


def whole_number(c: Column) -> Column:
    """A plain number written as 1000, 1000.0 or text -> BIGINT, rounded half
    away from zero; NULL for anything else."""
    return F.round(F.btrim(c.cast("string")).try_cast("decimal(38,6)"), 0).try_cast("bigint")


def to_cents(c: Column) -> Column:
    """A DOUBLE amount as exact integer cents (sums become order-free)."""
    return F.round(c * 100).cast("bigint")


def round_to_long(c: Column) -> Column:
    """Round a DOUBLE to the nearest BIGINT, ties to even."""
    return F.rint(c).try_cast("bigint")


def format_clp(c: Column) -> Column:
    """12345.9 -> '$ 12.345' (truncated, '.' thousands); bad/NULL -> ''."""
    # integers exactly; fractional values truncated toward zero
    whole = F.coalesce(c.try_cast("bigint"), c.try_cast("double").try_cast("bigint"))
    text = F.translate(F.format_number(whole, 0), ",", ".")
    return F.coalesce(F.concat(F.lit("$ "), text), F.lit(""))
