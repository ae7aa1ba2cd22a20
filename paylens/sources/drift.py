"""JSON documents whose fields drift (S5, X19): parsed as VARIANT, with a quarantine.

:func:`checked_envelopes` reads each document once.  Every item of either
envelope shape keeps its good fields; a field that holds something else than
its type becomes NULL and is reported with its path, the type it should have,
the type that was found and what stood there.  A text that is no JSON, or has
no list of items, is reported whole.  Nothing is dropped unseen: a document
gives its items, one report, or both.

Write the checked table once and take :func:`good_items` and
:func:`quarantine` from the copy, or each from the plan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paylens.sources.readers import _typed

PROBLEMS = "array<struct<path: string, expected: string, found: string, value: string>>"


def _kind(value: Column) -> Column:
    """OBJECT, ARRAY, STRING, BIGINT, VOID (a JSON null), ... or ``missing``."""
    return F.coalesce(F.regexp_extract(F.schema_of_variant(value), r"^\w+", 0), F.lit("missing"))


def _problem(path: Column, expected: str, found: Column, value: Column) -> Column:
    return F.struct(path.alias("path"), F.lit(expected).alias("expected"), found.alias("found"), value.alias("value"))


def _fields(body: Column, item: T.StructType) -> Column:
    """All fields of an object as found, in one pass; NULL if ``body`` is no object."""
    names = [f.name.replace("`", "``") for f in item.fields]
    return F.try_variant_get(body, "$", f"struct<{', '.join(f'`{n}`: variant' for n in names)}>")


def _parts(k: int) -> list[Column]:
    """What stands in the field: as found, as text, and its kind."""
    found = F.col(f"_found{k}")
    return [found, F.try_variant_get(found, "$", "string").alias(f"_text{k}"), _kind(found).alias(f"_kind{k}")]


def _field(where: Column, k: int, field: T.StructField) -> tuple[Column, Column]:
    """The field's value, and what is wrong with it (NULL if nothing), from what was found."""
    found, text, kind = F.col(f"_found{k}"), F.col(f"_text{k}"), F.col(f"_kind{k}")
    given = found.isNotNull() & ~F.is_variant_null(found)
    if isinstance(field.dataType, (T.NumericType, T.StringType)):
        scalar = F.when(~kind.isin("OBJECT", "ARRAY"), text)
        value = _typed(scalar, field.dataType)
    else:
        value = F.try_variant_get(found, "$", field.dataType.simpleString())
    wrong = F.when(given & value.isNull(), _problem(
        F.concat(where, F.lit(f".{field.name}")), field.dataType.simpleString(), kind, text))
    return value, wrong


def checked_envelopes(docs: DataFrame, item: T.StructType, text: str = "value") -> DataFrame:
    """The other columns of ``docs``, ``item`` (NULL if there is none) and
    ``problems`` of every item, and a row for each document without items to read.

    An empty list of items gives no row; a JSON null is no problem; a number
    may be written as 1000, 1000.0 or "1000".  A repeated name within an
    object makes the document no JSON.
    """
    rest = [c for c in docs.columns if c != text]
    parsed = docs.select(*rest, F.col(text).alias("_text"), F.try_parse_json(F.col(text)).alias("_doc"))
    # a step of its own for all that is taken from a whole document: beside the
    # explode it would be computed again, and the document carried, for every item
    lists = parsed.select(*rest, "_text", "_doc", F.try_variant_get("_doc", "$.data.data", "array<variant>").alias("_paged"),
                          F.try_variant_get("_doc", "$.data", "array<variant>").alias("_plain"))
    paged, both = F.col("_paged"), F.coalesce("_paged", "_plain")
    broken = F.when(F.col("_doc").isNull(), _problem(F.lit("$"), "JSON", F.lit("no JSON"), F.col("_text"))).when(
        both.isNull(), _problem(
            F.lit("$.data"), "ARRAY", _kind(F.try_variant_get("_doc", "$.data", "variant")), F.col("_text")))
    documents = lists.select(*rest, broken.alias("_broken"), both.alias("_items"),
                             F.when(paged.isNotNull(), F.lit("$.data.data[")).otherwise(F.lit("$.data[")).alias("_list"))
    items = F.transform("_items", lambda x, k: F.struct(k.alias("at"), x.alias("it")))
    nothing = F.array(F.struct(F.lit(None).cast("int").alias("at"), F.lit(None).cast("variant").alias("it")))
    rows = documents.select(*rest, "_broken", "_list", F.explode(F.coalesce(items, nothing)).alias("_it"))
    rows = rows.select(*rest, "_broken", "_list", "_it", F.try_variant_get(F.col("_it.it"), "$.attributes", "variant").alias("_inner"))
    inner = F.col("_inner")
    wrapped = inner.isNotNull() & ~F.is_variant_null(inner)
    rows = rows.select(*rest, "_broken", F.when(wrapped, inner).otherwise(F.col("_it.it")).alias("_body"),
                       F.concat("_list", F.col("_it.at").cast("string"), F.lit("]"),
                                F.when(wrapped, F.lit(".attributes")).otherwise(F.lit(""))).alias("_where"))
    body, where = F.col("_body"), F.col("_where")
    # each part once, whatever uses it
    kept = [*rest, "_broken", "_body", "_where", "_is_object"]
    rows = rows.select(*rest, "_broken", "_body", "_where", _fields(body, item).alias("_fields"))
    rows = rows.select(*kept[:-1], F.col("_fields").isNotNull().alias("_is_object"), "_fields.*").toDF(
        *kept, *[f"_found{k}" for k in range(len(item.fields))])
    rows = rows.select(*kept, *[part for k in range(len(item.fields)) for part in _parts(k)])
    fields = {f.name: _field(where, k, f) for k, f in enumerate(item.fields)}
    problems = (F.when(F.col("_broken").isNotNull(), F.array("_broken"))
                .when(~F.col("_is_object"), F.array(_problem(where, "OBJECT", _kind(body), body.cast("string"))))
                .otherwise(F.filter(F.array(*[wrong for _, wrong in fields.values()]), lambda p: p.isNotNull())))
    # a document without items has no object either
    read = F.when(F.col("_is_object"), F.struct(*[value.alias(n) for n, (value, _) in fields.items()]))
    return rows.select(*rest, read.alias("item"), problems.cast(PROBLEMS).alias("problems"))


def good_items(checked: DataFrame) -> DataFrame:
    """The items, drifting fields NULL."""
    rest = [c for c in checked.columns if c not in ("item", "problems")]
    # through an explode: else the optimizer filters below every step, where each
    # document would be written and parsed, and each item read, once more
    found = checked.select(*rest, F.explode_outer(F.array("item")).alias("_item")).filter(F.col("_item").isNotNull())
    return found.select(*rest, "_item.*")


def quarantine(checked: DataFrame) -> DataFrame:
    """One row per problem: path, expected, found, value beside the document's columns."""
    rest = [c for c in checked.columns if c not in ("item", "problems")]
    # outer, then filtered: for a plain inline the optimizer filters by the size of
    # ``problems``, so all checks of an item would be made twice
    found = checked.select(*rest, F.explode_outer("problems").alias("_problem")).filter(F.col("_problem").isNotNull())
    return found.select(*rest, "_problem.*")
