"""Month name <-> number lookups.

Pay rows carry the month as a Spanish name, expense rows as a number.
Both directions are literal maps evaluated inside the JVM; no join.
"""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

# The month names used by the published data, in calendar order.
MONTHS = [
    "Enero", "Febrero", "Marzo", "Abril", "Mayo", "Junio",
    "Julio", "Agosto", "Septiembre", "Octubre", "Noviembre", "Diciembre",
]


def _map(pairs) -> Column:
    return F.create_map(*[F.lit(x) for x in chain.from_iterable(pairs)])


def capitalize(c: Column) -> Column:
    """First character upper case, the rest lower case (str.capitalize)."""
    return F.concat(F.upper(F.substring(c, 1, 1)), F.lower(F.substring(c, 2, 1 << 30)))


def month_number(name: Column, default: int | None = None, normalize: bool = True) -> Column:
    """Month name -> 1..12; unknown names give ``default`` (NULL if None).

    ``normalize`` applies str.capitalize first, as the display table does.
    """
    key = capitalize(name) if normalize else name
    looked = _map((m, i + 1) for i, m in enumerate(MONTHS))[key]
    return looked if default is None else F.coalesce(looked, F.lit(default))


def month_name(number: Column, default: str | None = None) -> Column:
    """1..12 -> month name; anything else gives ``default`` (NULL if None)."""
    looked = _map((i + 1, m) for i, m in enumerate(MONTHS))[number.cast("int")]
    return looked if default is None else F.coalesce(looked, F.lit(default))
