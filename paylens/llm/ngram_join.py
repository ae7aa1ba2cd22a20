"""N-gram Jaccard join: a grouped prefix join over word shingles.

A document's set holds the hashes of its distinct five-word shingles.  Two
documents link if intersection / union reaches ``percent`` per cent.

1. Equal sets are one class.  Classes of equal size and equal prefix (the
   least shingles in hash order) are one group; groups, not documents, are
   listed under their prefix shingles.  The prefix is longer than a plain
   prefix filter needs, so that similar sets share several shingles of it:
   p + l - 1 for l shared ones.
2. Shingles of 2 to ``common`` groups pair these groups.  A pair stays if the
   sizes allow a link and enough prefix shingles can be shared.
3. More common shingles pair nobody.  A link that is carried by them alone
   needs l of them on both sides.  The classes that have so many ("rich")
   are joined once more by their whole sets, rarest shingles first, so that a
   shared passage in otherwise different texts drops out of the prefixes.
   Where many still share a prefix shingle (a family of near copies), each is
   compared with one of them.  Everywhere a pair counts under a shingle only if
   the shingles from there on could be enough: true under the first one that
   they share.
4. Pairs are expanded to classes and verified on whole sets.  Links give
   components; then every pair that 2 and 3 listed but did not compare, and
   that is not in one component yet, is compared too.  So no link between
   different texts is lost, while a family of copies never makes all its pairs.

Defined results: a null, empty or blank text has an empty set, links with
nothing and is its own component; fewer than five words make one shingle of
them all; rows that repeat a doc_id or a text are each returned; a null doc_id
is greater than all others (a component of null ids has a null id); an empty
table gives an empty result; other columns of the input are ignored.

Hashes have 64 bits: at 10^10 classes a handful may collide.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from paylens.llm.common import boxed, saved, shingle_set, temporary, unboxed
from paylens.llm.components import components

PERCENT = 80
WIDTH = 5
COMMON = 16


def prefix_size(n, percent: int = PERCENT):
    """Shingles of n of which similar sets must share one (ints or columns)."""
    return _floor(n * (100 - percent), 100) + 1


def needed(n, percent: int = PERCENT):
    """l: how many prefix shingles a set asks of a partner."""
    return _floor(prefix_size(n, percent), 4) + 1


def asked(n, percent: int = PERCENT):
    """What even the smallest partner of a set of n shares with it."""
    return needed(n - _floor(n * (100 - percent), 100), percent)


def _floor(a, b: int):
    return F.floor(a / b).cast("int") if isinstance(a, Column) else a // b


def shingles(text: bytes, width: int = WIDTH) -> np.ndarray:
    """The sorted shingle set of a text, as signed longs."""
    return np.sort(shingle_set(text.lower().split(), width).view(np.int64))


def class_of(tokens: np.ndarray) -> int:
    return np.uint64(xxhash.xxh3_64_intdigest(tokens.tobytes())).astype(np.int64).item()


def read_sets(docs: DataFrame, percent: int = PERCENT, width: int = WIDTH, common: int = COMMON) -> DataFrame:
    """Per document: doc_id, content, n, class, group; the first document of a
    group in a batch also has the group's prefix: ``rare`` shingles, and
    ``often`` those in over ``common`` groups of the batch, which are known to
    be common before anything is shuffled.  Rows without a doc_id or class at
    the end of a batch list the ``often`` shingles themselves as ``rare``."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, classes, groups, heads = [], [], [], []
            seen = set()
            for text in batch.column(2):
                tokens = shingles(text.as_py() or b"", width)
                head = tokens[:prefix_size(len(tokens), percent) + needed(len(tokens), percent) - 1]
                n.append(len(tokens))
                classes.append(class_of(tokens) if len(tokens) else None)
                group = class_of(np.append(head, len(tokens))) if len(tokens) else None
                groups.append(group)
                heads.append(None if group is None or group in seen else head)
                seen.add(group)
            new = [h for h in heads if h is not None]
            values, counts = np.unique(np.concatenate(new), return_counts=True) if new else (np.empty(0, np.int64),) * 2
            often = values[counts > common]
            rare = [None if h is None else h[~np.isin(h, often, kind="sort")] for h in heads]
            hot = [None if h is None else h[np.isin(h, often, kind="sort")] for h in heads]
            marks = [[None]] * (len(often) > 0)
            longs = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.concat_arrays([batch.column(0), pa.nulls(len(marks), pa.int64())]),
                 pa.concat_arrays([batch.column(1), pa.nulls(len(marks), pa.int64())]),
                 pa.array(n + [None] * len(marks), pa.int32()), pa.array(classes + [None] * len(marks), pa.int64()),
                 pa.array(groups + [None] * len(marks), pa.int64()),
                 pa.array(rare + [often] * len(marks), longs), pa.array(hot + [None] * len(marks), longs),
                 pa.array([False] * len(n) + [True] * len(marks), pa.bool_())],
                ["doc_id", "content", "n", "class", "group", "rare", "often", "mark"])

    rows = docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("content"), F.col("text").cast("binary"))
    return rows.mapInArrow(scan, "doc_id long, content long, n int, class long, group long, rare array<long>, "
                                 "often array<long>, mark boolean")


def shared_prefixes(table: DataFrame, common: int) -> tuple[DataFrame, DataFrame]:
    """(token, group, n) of prefix shingles in 2 to ``common`` groups; and of more common ones."""
    listed = table.select(F.explode("rare").alias("token"), "group", "n").repartition("token")
    counts = (listed.groupBy("token").agg(F.count("*").alias("rows"), F.min("group").alias("low"),
                                          F.max("group").alias("high"), F.max(F.col("group").isNull()).alias("marked"))
              .filter("marked or low < high")
              .select("token", (F.col("marked") | (F.col("rows") > common)).alias("hot")))
    shared = saved(listed.join(counts, "token").filter("group is not null").distinct(), "shared")
    hot = table.select(F.explode("often").alias("token"), "group", "n")
    return (shared.filter("not hot").select("token", "group", "n"),
            shared.filter("hot").select("token", "group", "n").unionByName(hot).distinct())


def _sizes_allow(a: str, b: str, percent: int) -> Column:
    return (100 * F.least(F.col(a), F.col(b))) >= percent * F.greatest(F.col(a), F.col(b))


def group_pairs(cold: DataFrame, hot: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """(a, b) groups that pass the filters by shared rare shingles; and the rich groups."""
    often = hot.groupBy("group").agg(F.first("n").alias("n"), F.count("*").alias("often"))
    often = saved(often, "often")
    left = cold.select("token", F.col("group").alias("a"), F.col("n").alias("n_a"))
    right = cold.select("token", F.col("group").alias("b"), F.col("n").alias("n_b"))
    pairs = (left.join(right, "token").filter((F.col("a") < F.col("b")) & _sizes_allow("n_a", "n_b", percent))
             .groupBy("a", "b", "n_a", "n_b").agg(F.count("*").alias("shared")))
    for side in "ab":
        pairs = pairs.join(often.select(F.col("group").alias(side), F.col("often").alias(f"often_{side}")), side, "left")
    more = F.least(F.coalesce("often_a", F.lit(0)), F.coalesce("often_b", F.lit(0)))
    wanted = F.greatest(asked(F.col("n_a"), percent), asked(F.col("n_b"), percent))
    rich = often.filter(F.col("often") >= asked(F.col("n"), percent)).select("group")
    return pairs.filter(F.col("shared") + more >= wanted).select("a", "b"), rich


def sets_of(docs: DataFrame, wanted: DataFrame, width: int = WIDTH) -> DataFrame:
    """class, n, tokens of the wanted classes (class, doc_id of one document)."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            classes, sets = [], []
            for asked_for, text in zip(*batch.columns, strict=True):
                tokens = shingles(text.as_py() or b"", width)
                if len(tokens) and class_of(tokens) == asked_for.as_py():  # else another text with its doc_id
                    classes.append(asked_for.as_py())
                    sets.append(tokens)
                if sum(map(len, sets)) > 1_000_000:
                    yield _sets(classes, sets)
                    classes, sets = [], []
            if classes:
                yield _sets(classes, sets)

    rows = docs.select(F.col("doc_id").cast("long").alias("_id"), F.col("text").cast("binary").alias("_text"))
    rows = rows.join(wanted, F.col("_id").eqNullSafe(F.col("doc_id"))).select("class", "_text")
    return rows.mapInArrow(scan, "class long, n int, tokens array<long>").dropDuplicates(["class"])


def _sets(classes: list, sets: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(classes, pa.int64()), pa.array(list(map(len, sets)), pa.int32()), pa.array(sets, pa.list_(pa.int64()))],
        ["class", "n", "tokens"])


def verified(pairs: DataFrame, sets: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The pairs (a, b) of classes whose sets are similar enough."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for left, right in zip(batch.column(2), batch.column(3), strict=True):
                x, y = left.values.to_numpy(), right.values.to_numpy()
                both = int((y[np.minimum(np.searchsorted(y, x), len(y) - 1)] == x).sum())
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays(batch.columns[:2], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    for side in "ab":
        pairs = pairs.join(sets.select(F.col("class").alias(side), F.col("tokens").alias(f"tokens_{side}"),
                                       F.col("n").alias(f"n_{side}")), side)
    return (pairs.filter(_sizes_allow("n_a", "n_b", percent)).select("a", "b", "tokens_a", "tokens_b")
            .mapInArrow(compare, "a long, b long"))


def _enough_left(x: str, y: str, percent: int) -> Column:
    """Whether the shingles left on both sides could make two sets similar."""
    left = F.least(F.col(f"left_{x}"), F.col(f"left_{y}"))
    return (100 + percent) * left >= percent * (F.col(f"n_{x}") + F.col(f"n_{y}"))


def rich_prefixes(sets: DataFrame, percent: int) -> DataFrame:
    """token, class, n, left (shingles from this one on), shared (classes with
    that shingle in their prefix): the rarest shingles of every set, counted
    among these sets."""
    listed = sets.select(F.explode("tokens").alias("token"), "class", "n").repartition("token")
    counted = listed.join(listed.groupBy("token").agg(F.count("*").alias("df")), "token")
    rank = F.row_number().over(Window.partitionBy("class").orderBy("df", "token"))  # the shingles of one document
    prefix = (counted.withColumn("rank", rank).filter(F.col("rank") <= prefix_size(F.col("n"), percent))
              .filter("df > 1").select("token", "class", "n", (F.col("n") - F.col("rank") + 1).alias("left")))
    prefix = saved(prefix, "prefix")
    return prefix.join(prefix.groupBy("token").agg(F.count("*").alias("shared")).filter("shared > 1"), "token")


def _both(rows: DataFrame, percent: int) -> DataFrame:
    """All pairs of classes under a token (few classes each)."""
    left, right = (rows.select("token", F.col("class").alias(s), F.col("n").alias(f"n_{s}"),
                               F.col("left").alias(f"left_{s}")) for s in "ab")
    return (left.join(right, "token").filter((F.col("a") < F.col("b")) & _enough_left("a", "b", percent))
            .select("a", "b").distinct())


def _with_one(rows: DataFrame) -> DataFrame:
    """Each class under a token with the one that has most common shingles."""
    weight = rows.groupBy("class").agg(F.count("*").alias("weight"))
    rows = rows.join(weight, "class")
    one = rows.groupBy("token").agg(F.max(F.struct("weight", "class"))["class"].alias("one"))
    return (rows.join(one, "token").filter("class != one")
            .select(F.least("class", "one").alias("a"), F.greatest("class", "one").alias("b")).distinct())


def _apart(rows: DataFrame, key: str, percent: int) -> DataFrame:
    """Pairs under a key whose classes are in different components.  rows: key,
    class, n, left, component.  Members of the key's largest component are compared
    only with the others, which are few."""
    sizes = rows.groupBy(key, "component").agg(F.count("*").alias("members"))
    most = sizes.groupBy(key).agg(F.max(F.struct("members", "component"))["component"].alias("largest"),
                                  F.count("*").alias("kinds")).filter("kinds > 1")
    rows = rows.join(most, key)
    others, every = (part.select(key, F.col("class").alias(s), F.col("n").alias(f"n_{s}"), F.col("left").alias(f"left_{s}"),
                                 F.col("component").alias(f"c_{s}"))
                     for s, part in (("x", rows.filter("component != largest")), ("y", rows)))
    return (others.join(every, key).filter((F.col("c_x") != F.col("c_y")) & _enough_left("x", "y", percent))
            .select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct())


def linked_classes(docs: DataFrame, table: DataFrame, percent: int = PERCENT, width: int = WIDTH,
                   common: int = COMMON) -> DataFrame:
    """node (class), component of all classes that link with another class."""
    cold, hot = shared_prefixes(table, common)
    pairs, rich = group_pairs(cold, hot, percent)
    pairs = saved(pairs, "pairs")
    members = saved(table.filter("class is not null").groupBy("group", "class")
                    .agg(F.min("doc_id").alias("doc_id"), F.first("n").alias("n")), "members")
    sized = members.groupBy("group").agg(F.min("class").alias("one"), F.count("*").alias("classes"))
    sized = saved(sized, "groups")
    mixed_groups = sized.filter("classes > 1")
    groups = (pairs.select(F.col("a").alias("group")).unionByName(pairs.select(F.col("b").alias("group")))
              .unionByName(rich).unionByName(mixed_groups.select("group")).distinct())
    sets = saved(sets_of(docs, members.join(groups, "group", "left_semi").select("class", "doc_id"), width), "sets")

    in_rich = members.join(rich.distinct(), "group", "left_semi").select("class")
    prefixes = saved(rich_prefixes(sets.join(in_rich, "class", "left_semi"), percent), "prefixes")
    first = pairs
    for side in "ab":
        first = first.join(sized.select(F.col("group").alias(side), F.col("one").alias(f"one_{side}")), side)
    first = first.select(F.least("one_a", "one_b").alias("a"), F.greatest("one_a", "one_b").alias("b"))
    inside = members.join(mixed_groups, "group").filter("class > one").select(F.col("one").alias("a"), F.col("class").alias("b"))
    few, many = prefixes.filter(F.col("shared") <= common), prefixes.filter(F.col("shared") > common)
    round1 = first.unionByName(inside).unionByName(_both(few, percent)).unionByName(_with_one(many)).distinct()
    links = saved(verified(round1, sets, percent), "links")

    # what was listed but not compared, and is not yet in one component
    known = saved(components(links), "components")

    def placed(rows: DataFrame) -> DataFrame:
        found = rows.join(known, F.col("class") == F.col("node"), "left").drop("node")
        return found.withColumn("component", F.coalesce("component", "class"))

    crowd = members.join(mixed_groups.select("group"), "group", "left_semi").select(
        "group", "class", "n", F.col("n").alias("left"))
    again = _apart(placed(crowd), "group", percent).unionByName(
        _apart(placed(many.drop("shared")), "token", percent))
    wide = pairs.join(mixed_groups.select(F.col("group").alias("a")), "a", "left_semi").unionByName(
        pairs.join(mixed_groups.select(F.col("group").alias("b")), "b", "left_semi").select("a", "b")).distinct()
    spot = placed(members.join(wide.select(F.col("a").alias("group")).unionByName(wide.select(F.col("b").alias("group")))
                               .distinct(), "group", "left_semi").select("group", "class", "n"))
    for side in "ab":
        wide = wide.join(spot.select(F.col("group").alias(side), F.col("class").alias(f"class_{side}"),
                                     F.col("component").alias(f"component_{side}")), side)
    wide = wide.filter("component_a != component_b").select(
        F.least("class_a", "class_b").alias("a"), F.greatest("class_a", "class_b").alias("b"))
    more = verified(again.unionByName(wide).distinct(), sets, percent)
    return components(links.unionByName(more))


def classified(docs: DataFrame, percent: int = PERCENT, width: int = WIDTH, common: int = COMMON) -> DataFrame:
    """Per document: doc_id, content, n, class, key (its component among classes)."""
    table = saved(read_sets(docs, percent, width, common), "documents")
    known = linked_classes(docs, table, percent, width, common)
    rows = table.filter("not mark").select("doc_id", "content", "n", "class")
    return rows.join(known, F.col("class") == F.col("node"), "left").withColumn("key", F.coalesce("component", "class"))


def jaccard_components(docs: DataFrame, percent: int = PERCENT, width: int = WIDTH, common: int = COMMON) -> DataFrame:
    """doc_id, n_shingles, component_id of every document."""
    with temporary(docs.sparkSession):
        rows = saved(classified(docs, percent, width, common).select("doc_id", "n", "key"), "classified", keep=True)
    least = rows.filter("key is not null").groupBy(F.col("key").alias("_key")).agg(F.min("doc_id").alias("least"))
    return rows.join(least, F.col("key") == F.col("_key"), "left").select(
        "doc_id", F.col("n").cast("long").alias("n_shingles"),
        F.when(F.col("key").isNull(), F.col("doc_id")).otherwise(F.col("least")).alias("component_id"))


def one_of_each(docs: DataFrame, percent: int = PERCENT, width: int = WIDTH, common: int = COMMON) -> DataFrame:
    """``docs`` with one document of each component: that of the least doc_id
    (documents without words all stay; of rows alike in doc_id and text, one)."""
    with temporary(docs.sparkSession):
        rows = saved(classified(docs, percent, width, common).select("doc_id", "content", "key"), "classified", keep=True)
    place = F.struct(F.col("doc_id").isNull(), "doc_id", "content")
    least = rows.filter("key is not null").groupBy(F.col("key").alias("_key")).agg(
        F.min(place).alias("one"), F.count("*").alias("rows")).filter("rows > 1")
    judged = rows.join(least, F.col("key") == F.col("_key")).withColumn("stays", place == F.col("one"))
    marks = judged.groupBy(F.col("doc_id").alias("_id"), F.col("content").alias("_content")).agg(
        F.max("stays").alias("_stays"), F.count("*").alias("_rows"))
    marks = marks.filter("not _stays or _rows > 1")
    texts = boxed(docs, F.xxhash64("text").alias("hash"), F.col("doc_id"))
    alike = (F.col("hash") == F.col("_content")) & F.col("doc_id").eqNullSafe(F.col("_id"))
    kept = unboxed(texts.join(marks, alike, "left_anti"), docs.columns)
    repeated = texts.join(marks.filter("_stays"), alike, "left_semi").dropDuplicates(["doc_id", "hash"])
    return kept.unionByName(unboxed(repeated, docs.columns))
