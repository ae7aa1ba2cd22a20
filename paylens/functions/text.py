"""Text expressions.

Every function maps Column -> Column and compiles to built-in Catalyst
expressions (lower, translate, regexp_replace, concat ...), so it stays
inside whole-stage codegen; no Python runs per row.
"""

from __future__ import annotations

import sys
import unicodedata
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# The 16 accented letters folded by the indexed search vector,
# and what each becomes (same position in both strings).
SEARCH_VECTOR_FROM = "áéíóúàèìòùäëïöüñ"
SEARCH_VECTOR_TO = "aeiouaeiouaeioun"


def unaccent_lower(c: Column) -> Column:
    """Lower case, then fold the 16 letters above; nothing else changes."""
    return F.translate(F.lower(c), SEARCH_VECTOR_FROM, SEARCH_VECTOR_TO)


# --- full fold: lower -> NFKD -> keep ASCII -------------------------------
#
# The tables are derived by rule from the Unicode database at import time, for
# every code point: what lower() leaves of it, decomposed for compatibility and
# stripped to ASCII.  One letter: one ``translate``.  Several letters: layer k of
# ``_LAYERS`` translates the character to its k-th letter, or to nothing.
# Everything else that is not ASCII disappears at the end, combining marks of
# decomposed input included.

def _ascii_fold(ch: str) -> str:
    return unicodedata.normalize("NFKD", ch.lower()).encode("ascii", "ignore").decode("ascii")


def _build_fold_tables():
    single, multi = {}, {}
    for cp in range(0x80, sys.maxunicode + 1):
        if 0xD800 <= cp <= 0xDFFF:
            continue
        folded = _ascii_fold(chr(cp))
        if len(folded) == 1:
            single[chr(cp)] = folded
        elif folded:
            multi[chr(cp)] = folded
    # translate() deletes what has no counterpart: longest forms first
    order = sorted(multi, key=lambda ch: (-len(multi[ch]), ch))
    deepest = max(map(len, multi.values()))
    layers = ["".join(multi[ch][k] for ch in order if len(multi[ch]) > k) for k in range(deepest)]
    return "".join(single), "".join(single.values()), "".join(order), layers


_FOLD_FROM, _FOLD_TO, _MULTI_CHARS, _LAYERS = _build_fold_tables()


def _spell_out(c: Column) -> Column:
    """Multi-letter forms (ligatures, fractions, units ...) letter by letter."""
    def spelled(ch: Column) -> Column:
        several = F.translate(ch, _MULTI_CHARS, "") == ""
        return F.when(several, F.concat(*[F.translate(ch, _MULTI_CHARS, k) for k in _LAYERS])).otherwise(ch)

    return F.array_join(F.transform(F.array_remove(F.split(c, ""), ""), spelled), "")


def fold_text(c: Column, strip: bool = False) -> Column:
    """``unicodedata.normalize('NFKD', x.lower()).encode('ascii', 'ignore')``.

    NULL and blank become ''.  ``strip`` also trims surrounding whitespace.
    Cost: lower, one ``translate`` pass, one regex pass; characters that fold
    to several letters are spelled out only in rows holding one (detected by a
    second translate that deletes them and changes the length).
    """
    low = F.lower(c)
    has_multi = F.length(F.translate(low, _MULTI_CHARS, "")) != F.length(low)
    low = F.when(has_multi, _spell_out(low)).otherwise(low)
    out = F.translate(low, _FOLD_FROM, _FOLD_TO)
    out = F.regexp_replace(out, r"[^\x00-\x7F]", "")
    if strip:
        out = py_strip(out)
    return F.coalesce(out, F.lit(""))


# Every character Python's str.strip() removes, derived from str.isspace.
_WHITESPACE = "".join(ch for ch in map(chr, range(0x3001)) if ch.isspace())


def py_strip(c: Column) -> Column:
    """str.strip(): remove leading/trailing Unicode whitespace (no regex)."""
    return F.btrim(c, F.lit(_WHITESPACE))


def search_words(text: str | None) -> list[str]:
    """Driver-side: fold a typed search string and split it into words."""
    if not text:
        return []
    folded = unicodedata.normalize("NFKD", text.strip().lower())
    return folded.encode("ascii", "ignore").decode("ascii").split()


def person_key(*parts: Column, upper: bool = True) -> Column:
    """Trim each part (upper-cased by default), skip blanks, join with one
    space, then collapse one level of double spaces and strip.

    Blank or NULL parts contribute nothing (``concat_ws`` skips NULLs).
    """
    cleaned = []
    for p in parts:
        s = py_strip(p.cast("string"))
        if upper:
            s = F.upper(s)
        cleaned.append(F.nullif(s, F.lit("")))
    joined = F.concat_ws(" ", *cleaned)
    return py_strip(F.replace(joined, F.lit("  "), F.lit(" ")))


def audit_full_name(first: Column, last1: Column, last2: Column) -> Column:
    """upper(trim(a) || ' ' || trim(b) || ' ' || trim(c)), NULL parts as ''.

    A missing part leaves its separator in place (kept as in the audits).
    """
    def part(x):
        return F.trim(F.coalesce(x.cast("string"), F.lit("")))
    return F.upper(F.concat(part(first), F.lit(" "), part(last1), F.lit(" "), part(last2)))


def ellipsis(c: Column, n: int = 100) -> Column:
    """Keep the first n characters and append '...' when longer."""
    return F.when(F.length(c) > n, F.concat(F.substring(c, 1, n), F.lit("..."))).otherwise(c)


def strip_title(c: Column) -> Column:
    """Drop a leading 'Diputado ' / 'Diputada ' title (either case of D)."""
    # Fixed value: the title pattern.
    return F.regexp_replace(c, r"^[Dd]iputad[oa]\s+", "")


def search_vector(first: Column, last1: Column, last2: Column, full_fold: bool = False) -> Column:
    """The stored, lower-cased and folded full name used by searches."""
    name = F.concat(F.coalesce(first.cast("string"), F.lit("")), F.lit(" "),
                    F.coalesce(last1.cast("string"), F.lit("")), F.lit(" "),
                    F.coalesce(last2.cast("string"), F.lit("")))
    return fold_text(name, strip=True) if full_fold else unaccent_lower(name)


def legislative(*cols: Column) -> Column:
    """True when any column names the Senate or the Chamber (any case/accent)."""
    hits = [fold_text(c).rlike("senado|camara") for c in cols]
    return reduce(lambda a, b: a | b, hits)
