"""HTML pages as data (R1, R2, X16): table rows, links and headings.

A table of pages is processed in parallel.  Links and headings are regular
expressions over whole pages.  Table rows come from tag tokens: a page without
its comments, scripts and styles is cut before every tag of a table, a row or a
cell, and running counts over the tokens of a page, made page by page in its
task, give the depth of tables and number tables, rows and cells.  End tags of rows and cells are never
needed: the next row or cell, or the end of the table, closes them.
"""

from __future__ import annotations

from collections.abc import Iterator
from html.entities import name2codepoint

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paylens.functions.text import strip_title

_NAMED = r"&([A-Za-z][A-Za-z0-9]{1,8});"
_NUMBER = r"&#(?:([0-9]{1,7})|[xX]([0-9a-fA-F]{1,6}));"


def _entities() -> Column:
    """The named entities of HTML, as the standard library lists them; a no-break space is a blank."""
    known = {**name2codepoint, "apos": ord("'"), "nbsp": ord(" ")}
    return F.str_to_map(F.lit("\x01".join(f"{n}\x02{chr(k)}" for n, k in sorted(known.items()))), F.lit("\x01"), F.lit("\x02"))


def decode_entities(c: Column) -> Column:
    """Named (``&aacute;``) and numeric (``&#225;``, ``&#xe1;``) entities as
    characters; unknown ones stay.  Decoded once: ``&amp;lt;`` is ``&lt;``."""

    def one(token: Column) -> Column:
        decimal, hexadecimal = (F.nullif(F.regexp_extract(token, _NUMBER, k), F.lit("")) for k in (1, 2))
        code = F.coalesce(decimal.try_cast("int"), F.conv(hexadecimal, 16, 10).try_cast("int"))
        fits = code.between(1, 0x10FFFF) & ~code.between(0xD800, 0xDFFF)
        sign = F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")  # a code point is its four bytes
        return F.coalesce(F.when(code == 0xA0, " ").when(fits, sign),
                          F.try_element_at(_entities(), F.regexp_extract(token, _NAMED, 1)), token)

    def piece(part: Column) -> Column:
        token = F.regexp_extract(part, f"^(?:{_NAMED}|{_NUMBER})", 0)
        return F.when(token == "", part).otherwise(F.concat(one(token), F.substr(part, F.length(token) + 1)))

    decoded = F.array_join(F.transform(F.split(c, f"(?={_NAMED}|{_NUMBER})"), piece), "")
    return F.when(c.contains("&"), decoded).otherwise(c)


def strip_tags(c: Column) -> Column:
    """Inner HTML -> text: tags removed, entities decoded, blanks trimmed."""
    return F.trim(decode_entities(F.regexp_replace(c, r"<[^>]*>", "")))


# Comments, and elements whose content is no markup; an unclosed one runs to the end.
_HIDDEN = r"(?is)<!--.*?(?:-->|\z)|<(script|style|template)\b[^>]*>.*?(?:</\1\s*>|\z)"


def _tokens(pages: DataFrame, html: str, key: str, tags: dict[str, str]) -> DataFrame:
    """_page, key, parts, kinds: the pieces of every page, each with the tag it starts with."""
    any_tag = "|".join(tags.values())
    clean = F.regexp_replace(F.col(html), _HIDDEN, " ")
    # numbered before they are cut
    numbered = pages.select(F.monotonically_increasing_id().alias("_page"), F.col(key), clean.alias("_html"))
    parts = numbered.select("_page", key, F.split("_html", rf"(?i)(?=</?(?:{any_tag})[\s/>])").alias("_parts"))

    def kind(part: Column) -> Column:
        found = F.lit("text")
        for name, tag in tags.items():
            found = (F.when(part.rlike(rf"(?i)^<{tag}[\s/>]"), name)
                     .when(part.rlike(rf"(?i)^</{tag}[\s/>]"), f"/{name}").otherwise(found))
        return found

    return parts.select("_page", key, "_parts", F.transform("_parts", kind).alias("_kinds")).filter("_parts is not null")


_OUTER = ("table", "row", "cell", "/row", "/cell")


def _places(kinds: list[str]) -> Iterator[tuple]:
    """pos, depth, table_no, last, cells, row_no of a page's pieces within rows:
    depth of tables, and counts of the outer tables, rows and cells so far;
    ``last`` is what was opened or closed last, outside inner tables."""
    level = low = tables = cells = rows = before = first = 0
    last = frame = None
    for pos, kind in enumerate(kinds):
        level += (kind == "table") - (kind == "/table")
        low = min(low, level)  # an end tag too many closes nothing
        depth = level - low
        if depth == 1 and kind in _OUTER:
            last = kind
            cells += kind == "cell"
            # the row of a cell is open unless the table has just begun or a row was closed
            implied = kind == "cell" and frame in ("table", "/row") and cells == before + 1
            rows += kind == "row" or implied
            if kind in ("table", "row", "/row"):
                frame, before = kind, cells
            if kind == "table":
                tables, first = tables + 1, rows
        if depth > 0 and rows > first:
            yield pos, depth, tables - 1, last, cells, rows - first - 1


def _placed(tokens: DataFrame, key: str) -> DataFrame:
    """_page, key, _pos, _part, _kind and the places of the pieces within rows."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int32(), pa.int32(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
        for batch in batches:
            page, keys, parts, found = batch.columns
            for k in range(batch.num_rows):
                names = found[k].as_py()
                placed = list(_places(names))
                if placed:
                    columns = list(zip(*placed, strict=True))
                    row = pa.array([k] * len(placed), pa.int32())
                    yield pa.RecordBatch.from_arrays(
                        [page.take(row), keys.take(row), parts[k].values.take(pa.array(columns[0], pa.int32())),
                         pa.array([names[p] for p in columns[0]], pa.string()),
                         *[pa.array(c, t) for c, t in zip(columns, kinds, strict=True)]],
                        ["_page", key, "_part", "_kind", "_pos", "_depth", "table_no", "_last", "_cells", "row_no"])

    schema = T.StructType([tokens.schema["_page"], T.StructField(key, tokens.schema[key].dataType)])
    for name, kind in (("_part", T.StringType()), ("_kind", T.StringType()), ("_pos", T.IntegerType()),
                       ("_depth", T.IntegerType()), ("table_no", T.LongType()), ("_last", T.StringType()),
                       ("_cells", T.LongType()), ("row_no", T.LongType())):
        schema = schema.add(name, kind)
    return tokens.mapInArrow(scan, schema)


def table_rows(pages: DataFrame, *, html: str = "html", key: str = "page_id",
               table_tag: str = "table", row_tag: str = "tr", cell_tag: str = "t[dh]",
               first_table_only: bool = True) -> DataFrame:
    """One output row per table row: (key, table_no, row_no, cells).

    Defaults read ``<table>/<tr>/<td|th>``; other tags (for example
    ``ul``/``li``/``a``) treat lists as tables.  ``first_table_only`` keeps
    the first table of each page, as the monthly scrape did.  A table inside a
    cell counts as that cell's text.  Comments, scripts and styles hold no
    tables.  End tags of rows and cells, and of the last table, may be missing;
    a cell outside a row starts one; text outside cells is left out.  A
    ``colspan`` repeats its cell in each of its columns.
    """
    depth = F.col("_depth")
    rows = _placed(_tokens(pages, html, key, {"table": table_tag, "row": row_tag, "cell": cell_tag}), key)
    outer = (depth == 1) & F.col("_kind").isin(*_OUTER)
    kind = F.col("_kind")
    if first_table_only:
        rows = rows.filter("table_no = 0")
    # an inner table's tags part words
    text = F.when(outer, F.regexp_replace("_part", "^<[^>]*>", "")).otherwise(F.regexp_replace("_part", r"<[^>]*>", " "))
    inside = F.col("_last") == "cell"
    pieces = rows.groupBy("_page", key, "table_no", "row_no", F.when(inside, F.col("_cells")).alias("_cell")).agg(
        F.sort_array(F.collect_list(F.struct("_pos", text.alias("text")))).alias("_texts"),
        F.max(F.when(outer & (kind == "cell"), _colspan(F.col("_part")))).alias("_wide"))
    # line ends before the next tag are the page's layout
    value = F.btrim(strip_tags(F.array_join(F.transform("_texts", lambda t: t["text"]), "")), F.lit(" \t\r\n\f"))
    cell = F.when(F.col("_cell").isNotNull(), F.struct("_cell", value.alias("text"), "_wide"))
    tables = pieces.groupBy("_page", key, "table_no", "row_no").agg(F.sort_array(F.collect_list(cell)).alias("_row"))
    cells = F.flatten(F.transform("_row", lambda c: F.array_repeat(c["text"], c["_wide"])))
    return tables.select(key, "table_no", F.col("row_no").cast("int").alias("row_no"), cells.alias("cells"))


def _colspan(tag: Column) -> Column:
    """How many columns a cell takes: 1 to 1,000, as HTML has it."""
    asked = F.regexp_extract(tag, r"""(?i)^<[^>]*\scolspan\s*=\s*["']?\s*([0-9]{1,5})""", 1).try_cast("int")
    return F.least(F.lit(1000), F.greatest(F.lit(1), F.coalesce(asked, F.lit(1))))


# An anchor: its quoted href, and the HTML up to its end tag.
LINK = r"""(?is)<a\b[^>]*?\bhref\s*=\s*("[^"]*"|'[^']*')[^>]*>(.*?)</a>"""


def links(pages: DataFrame, *, html: str = "html", key: str = "page_id",
          href_pattern: str | None = None) -> DataFrame:
    """Distinct (key, href, text) of every anchor with non-blank text (R2).

    ``href_pattern`` (a regex with one group, e.g. an id in a profile URL)
    keeps only matching links and returns the group as ``link_id``.
    """
    # one row per whole anchor match, then both groups from that match
    anchors = pages.select(key, F.explode(F.regexp_extract_all(F.col(html), F.lit(LINK), 0)).alias("_a"))
    quoted = F.regexp_extract("_a", LINK, 1)
    out = anchors.select(key, F.substring(quoted, F.lit(2), F.length(quoted) - 2).alias("href"),
                         strip_tags(F.regexp_extract("_a", LINK, 2)).alias("text"))
    out = out.filter(F.col("text") != "")
    if href_pattern:
        out = (out.withColumn("link_id", F.regexp_extract("href", href_pattern, 1))
               .filter(F.col("link_id") != ""))
    return out.distinct()


def heading(pages: DataFrame, *, html: str = "html", key: str = "page_id",
            tag: str = "h2") -> DataFrame:
    """First heading of each page as text, a leading 'Diputado/a ' title removed."""
    raw = F.regexp_extract(F.col(html), rf"(?is)<{tag}\b[^>]*>(.*?)</{tag}>", 1)
    text = strip_tags(raw)
    return pages.select(key, strip_title(text).alias("title"))
