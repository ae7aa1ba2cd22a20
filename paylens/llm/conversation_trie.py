"""A prefix trie of conversations, by a skeleton of range splitters.

Conversations are rebuilt from turns (see :func:`rebuilt`).  A node is a
distinct sequence of first turns, known by the depth and the exclusive or of
the 128-bit hashes of (position, role, text) of its turns.

1. Turns are numbered, and their hashes combined along each conversation, over
   ranges of (conversation, position): a conversation of any length is cut into
   ranges, none is ever held in one task.  Texts are hashed in the scan and
   never shuffled.
2. Nodes are counted by an aggregation.  A node of one member is the rest of
   one conversation: its numbers need no trie.  The path of a conversation is
   its *shared* nodes, those of two or more members, and the root.
3. Paths are sorted: the members of a node are one run.  Splitters, quantiles of
   a sample bounded by ``per_shard`` a shard, deal them into shards.  A node
   whose run crosses a splitter is a prefix of its path, so the trie of the
   splitter paths, the skeleton, holds all nodes that more than one shard sees.
   It is broadcast: at most a path of shared turns for each shard.
4. Each shard is read in order with a stack.  Nodes outside the skeleton are
   finished there; a skeleton node gives what it has of its other subtrees.
   These partial sums are reduced per node, then once more from every skeleton
   node to all nodes above it.

The hash of the members that end in a skeleton node needs them in order: they
are streamed, a node in one task, holding one number at a time.

Defined results: rows without a conv_id are ignored; rows of one conversation
and turn are taken in the order of a hash of role and text; a null turn is
first; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from paylens.llm.common import hashed_sample, running, saved, temporary, words

MOST = 4  # h is below this
GROUP = 20
PER_SHARD = 32
NOTHING = hashlib.sha256().hexdigest()
ROOT = (0, 0, 0)

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
HEAD = "array<struct<place long, a long, b long, tokens long>>"
NODE = "struct<depth long, p long, q long, n long, conv_id long, tokens long>"


# ------------------------------------------------------------ turns

def hashed_turns(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, a and b (two hashes of role and text), tokens."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    # the length of the role keeps role and text apart
    return conversations.filter("conv_id is not null").select(
        F.col("conv_id").cast("long"), F.col("turn"), F.xxhash64(F.length(role), role, text).alias("a"),
        F.xxhash64(F.lit("second"), F.length(role), role, text).alias("b"), F.size(words(text)).cast("long").alias("tokens"))


def taken(conv_id: Column) -> Column:
    """h: how many first turns a conversation takes from the first of its group."""
    return (F.crc32(conv_id.cast("string").cast("binary")) % MOST).cast("long")


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """conv_id, depth, a, b, tokens of the rebuilt turns; and conv_id, length of
    every conversation.  Conversation c has the first h turns of c - c % 20, then
    its own after its first h."""
    spots = saved(running(turns.withColumn("one", F.lit(1)), ["conv_id"], ["turn", "a", "b"], "one", "place").drop("one"), "turns")
    base = F.col("conv_id") - F.col("conv_id") % GROUP
    all_ids = spots.groupBy("conv_id").agg(F.count("*").alias("own"))
    heads = (spots.filter((F.col("place") < MOST - 1) & (F.col("conv_id") == base)).groupBy("conv_id")
             .agg(F.collect_list(F.struct("place", "a", "b", "tokens")).alias("head"))  # at most three
             .select(F.col("conv_id").alias("_base"), "head"))
    h = taken(F.col("conv_id"))
    convs = (all_ids.withColumn("base", base).join(heads, F.col("base") == F.col("_base"), "left")
             .withColumn("h", h)
             .withColumn("head", F.coalesce(F.filter("head", lambda x: x["place"] < F.col("h")), F.array().cast(HEAD)))
             .withColumn("got", F.size("head").cast("long")))
    convs = saved(convs.select("conv_id", "h", "got", "head", (F.col("got") + F.greatest(F.lit(0), F.col("own") - F.col("h")))
                               .alias("length")), "convs")
    late = spots.filter(F.col("place") >= h).join(convs.select(F.col("conv_id").alias("_id"), "got"), F.col("conv_id") == F.col("_id"))
    own = late.select("conv_id", (F.col("place") - h + F.col("got") + 1).alias("depth"), "a", "b", "tokens")
    first = convs.select("conv_id", F.explode("head").alias("t")).select(
        "conv_id", (F.col("t.place") + 1).alias("depth"), "t.a", "t.b", "t.tokens")
    return own.unionByName(first), convs.select("conv_id", "length")


def with_prefixes(rows: DataFrame) -> DataFrame:
    """conv_id, depth, tokens, and the node's p and q: exclusive ors of the hashes
    of the turns so far.  Ranges of turns are combined by themselves and then
    with what the ranges before them give."""
    placed = rows.select("conv_id", "depth", "tokens", F.xxhash64("depth", "a", "b").alias("x"),
                         F.xxhash64("b", "a", "depth").alias("y"))
    cut = saved(placed.repartitionByRange("conv_id", "depth").withColumn("range", F.spark_partition_id()), "ranges")
    sums = cut.groupBy("conv_id", "range").agg(F.bit_xor("x").alias("x"), F.bit_xor("y").alias("y"))
    before = Window.partitionBy("conv_id").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select(F.col("conv_id").alias("_id"), F.col("range").alias("_range"),
                         *[F.coalesce(F.bit_xor(c).over(before), F.lit(0)).alias(f"start_{c}") for c in "xy"])
    inside = Window.partitionBy("range", "conv_id").orderBy("depth").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = cut.withColumns({f"local_{c}": F.bit_xor(c).over(inside) for c in "xy"})
    joined = local.join(starts, (F.col("conv_id") == F.col("_id")) & (F.col("range") == F.col("_range")))
    return joined.select("conv_id", "depth", "tokens", F.col("local_x").bitwiseXOR(F.col("start_x")).alias("p"),
                         F.col("local_y").bitwiseXOR(F.col("start_y")).alias("q"))


# ------------------------------------------------------------ shards

def splitters_of(paths: DataFrame, total: int, shards: int, per_shard: int) -> list[tuple]:
    """The first (path, conv_id) of every shard but the first, from a sample of
    about ``shards * per_shard`` paths at most."""
    sample = hashed_sample(paths.select("keys", "conv_id"), "conv_id", total, shards * per_shard).collect()
    ordered = sorted((tuple(map(tuple, r["keys"])), r["conv_id"]) for r in sample)
    return sorted({ordered[len(ordered) * k // shards] for k in range(1, shards)}) if ordered else []


def skeleton_of(splitters: list[tuple]) -> set[tuple]:
    """The nodes of the splitter paths, and the root."""
    return {ROOT} | {node for path, _ in splitters for node in path}


def dealt(paths: DataFrame, splitters: list[tuple]) -> DataFrame:
    """``paths`` with the number of their shard."""
    known = paths.sparkSession.sparkContext.broadcast(splitters)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, ids = batch.column("keys").to_pylist(), batch.column("conv_id").to_pylist()
            shard = [bisect_right(known.value, (tuple((k["depth"], k["p"], k["q"]) for k in path), c))
                     for path, c in zip(keys, ids, strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(shard, pa.int32())], [*batch.schema.names, "shard"])

    return paths.mapInArrow(scan, f"conv_id long, length long, path array<{NODE}>, keys array<struct<depth long, p long, q long>>, "
                                  "shard int")


_OUT = [("kind", pa.int32()), ("conv_id", pa.int64()), ("depth", pa.int64()), ("parent_conv_id", pa.int64()),
        ("n_convs", pa.int64()), ("n_children", pa.int64()), ("n_leaves", pa.int64()), ("saved_tokens", pa.int64()),
        ("ends_sha256", pa.string()), ("p", pa.int64()), ("q", pa.int64()), ("tokens", pa.int64()),
        ("above", pa.list_(pa.struct([("depth", pa.int64()), ("p", pa.int64()), ("q", pa.int64())]))), ("end", pa.int64())]
OUT = ("kind int, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, "
       "saved_tokens long, ends_sha256 string, p long, q long, tokens long, above array<struct<depth long, p long, q long>>, end long")
LOCAL, PARTIAL, END = 0, 1, 2


class Open:
    """A node on the stack: what is known of its subtree so far."""

    __slots__ = ("key", "node", "shared", "children", "leaves", "saved", "ends", "many")

    def __init__(self, key: tuple, node: dict, shared: bool) -> None:
        self.key, self.node, self.shared = key, node, shared
        self.children = self.leaves = self.saved = 0
        self.ends, self.many = hashlib.sha256(), 0

    def end(self, conv_id: int) -> None:
        self.ends.update(b",%d" % conv_id if self.many else b"%d" % conv_id)
        self.many += 1


def finished(sharded: DataFrame, skeleton: set[tuple]) -> DataFrame:
    """Rows of kind LOCAL: finished nodes; PARTIAL: what a shard has of a skeleton
    node, without the subtrees of skeleton nodes below it; END: a conversation
    that ends in a skeleton node."""
    frame = sharded.sparkSession.sparkContext.broadcast(skeleton)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = frame.value
        shard, stack, out = None, [], []

        def close() -> None:
            top = stack.pop()
            node, above = top.node, stack[-1] if stack else None
            if top.shared:
                out.append((PARTIAL, node["conv_id"], node["depth"], above and above.node["conv_id"], node["n"], top.children,
                            top.leaves, top.saved, None, node["p"], node["q"], node["tokens"],
                            [dict(zip(("depth", "p", "q"), x.key, strict=True)) for x in [*stack, top]], None))
                return
            leaves = top.leaves or 1
            kept = top.saved + (node["n"] - 1) * node["tokens"]
            out.append((LOCAL, node["conv_id"], node["depth"], above.node["conv_id"], node["n"], top.children, leaves, kept,
                        top.ends.hexdigest(), node["p"], node["q"], None, None, None))
            above.children += 1
            above.leaves += leaves
            above.saved += kept

        for batch in batches:
            for part, conv_id, length, path in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if part != shard:
                    while stack:
                        close()
                    shard = part
                keys = [(node["depth"], node["p"], node["q"]) for node in path]
                common = 0
                while common < min(len(stack), len(keys)) and stack[common].key == keys[common]:
                    common += 1
                while len(stack) > common:
                    close()
                for key, node in zip(keys[common:], path[common:], strict=True):
                    stack.append(Open(key, node, key in known))
                top = stack[-1]
                if length > top.node["depth"]:  # the rest of the conversation is its own
                    top.children += 1
                    top.leaves += 1
                elif top.shared:
                    out.append((END, *[None] * 8, top.node["p"], top.node["q"], None, None, conv_id))
                else:
                    top.end(conv_id)
                if len(out) >= 10_000:
                    yield _batch(out)
                    out.clear()
        while stack:
            close()
        if out:
            yield _batch(out)

    ordered = sharded.repartition("shard").sortWithinPartitions("shard", "keys", "conv_id")
    return ordered.select("shard", "conv_id", "length", "path").mapInArrow(scan, OUT)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(zip(*rows, strict=True), _OUT, strict=True)],
                                      [n for n, _ in _OUT])


def ends_of(rows: DataFrame) -> DataFrame:
    """p, q, ends_sha256: the hash of the conversations (``end``) of each node, in order."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, None
        for batch in batches:
            out = []
            for p, q, end in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (p, q) != key:
                    if state is not None:
                        out.append((*key, state.hexdigest()))
                    key, state = (p, q), hashlib.sha256(b"%d" % end)
                else:
                    state.update(b",%d" % end)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(
                    zip(*out, strict=True), (pa.int64(), pa.int64(), pa.string()), strict=True)], ["p", "q", "ends_sha256"])
        if state is not None:
            yield pa.RecordBatch.from_arrays([pa.array([key[0]], pa.int64()), pa.array([key[1]], pa.int64()),
                                              pa.array([state.hexdigest()])], ["p", "q", "ends_sha256"])

    ordered = rows.select("p", "q", "end").repartition("p", "q").sortWithinPartitions("p", "q", "end")
    return ordered.mapInArrow(scan, "p long, q long, ends_sha256 string")


def reduced(rows: DataFrame) -> DataFrame:
    """The finished skeleton nodes: their partial sums, then those of all skeleton
    nodes below them."""
    partial = rows.filter(F.col("kind") == PARTIAL)
    # at most the nodes of the splitter paths
    nodes = saved(partial.groupBy("depth", "p", "q").agg(
        F.first("conv_id").alias("conv_id"), F.first("parent_conv_id").alias("parent_conv_id"), F.first("n_convs").alias("n_convs"),
        F.first("tokens").alias("tokens"), F.first("above").alias("above"), F.sum("n_children").alias("children"),
        F.sum("n_leaves").alias("leaves"), F.sum("saved_tokens").alias("saved")), "skeleton")
    parent = F.element_at("above", -2)  # null for the root
    below = (nodes.filter(F.size("above") > 1).groupBy(parent["depth"].alias("_d"), parent["p"].alias("_p"), parent["q"].alias("_q"))
             .agg(F.count("*").alias("framed")))
    same = (F.col("depth") == F.col("_d")) & (F.col("p") == F.col("_p")) & (F.col("q") == F.col("_q"))
    nodes = nodes.join(below, same, "left").drop("_d", "_p", "_q").withColumn(
        "n_children", F.col("children") + F.coalesce("framed", F.lit(0)))
    own = nodes.withColumn("leaves", F.when(F.col("n_children") == 0, 1).otherwise(F.col("leaves"))).withColumn(
        "saved", F.col("saved") + (F.col("n_convs") - 1) * F.col("tokens"))
    sums = (own.select(F.explode("above").alias("x"), "leaves", "saved")
            .groupBy(F.col("x.depth").alias("_d"), F.col("x.p").alias("_p"), F.col("x.q").alias("_q"))
            .agg(F.sum("leaves").alias("n_leaves"), F.sum("saved").alias("saved_tokens")))
    ends = ends_of(rows.filter(F.col("kind") == END)).select(F.col("p").alias("_ep"), F.col("q").alias("_eq"), "ends_sha256")
    return (nodes.join(sums, same).join(ends, (F.col("p") == F.col("_ep")) & (F.col("q") == F.col("_eq")), "left")
            .withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(NOTHING))).select(*COLUMNS))


# ------------------------------------------------------------ the trie

def prefix_trie(conversations: DataFrame, shards: int | None = None, per_shard: int = PER_SHARD) -> DataFrame:
    """One row per node (see ``COLUMNS``).  shards: as many as shuffle partitions, by default."""
    spark = conversations.sparkSession
    shards = shards or int(spark.conf.get("spark.sql.shuffle.partitions"))
    with temporary(spark):
        turns, convs = rebuilt(hashed_turns(conversations))
        turns = saved(with_prefixes(turns), "prefixes")
        nodes = saved(turns.groupBy("depth", "p", "q").agg(F.count("*").alias("n"), F.min("conv_id").alias("first"),
                                                           F.first("tokens").alias("size")).filter("n > 1"), "nodes")
        marks = nodes.select(F.col("depth").alias("_d"), F.col("p").alias("_p"), F.col("q").alias("_q"), "n", "first", "size")
        same = (F.col("depth") == F.col("_d")) & (F.col("p") == F.col("_p")) & (F.col("q") == F.col("_q"))
        node = F.struct("depth", "p", "q", "n", F.col("first").alias("conv_id"), F.col("size").alias("tokens"))
        shared = turns.join(marks, same).groupBy(F.col("conv_id").alias("_id")).agg(F.sort_array(F.collect_list(node)).alias("shared"))
        total, least = convs.agg(F.count("*"), F.min("conv_id")).first()  # a row
        top = F.struct(*[F.lit(v).cast("long").alias(c) for c, v in zip(
            ("depth", "p", "q", "n", "conv_id", "tokens"), (*ROOT, total, least, 0), strict=True)])
        paths = (convs.join(shared, F.col("conv_id") == F.col("_id"), "left")
                 .select("conv_id", "length", F.concat(F.array(top), F.coalesce("shared", F.array().cast(f"array<{NODE}>"))).alias("path")))
        paths = saved(paths.withColumn("keys", F.transform("path", lambda x: F.struct(
            x["depth"].alias("depth"), x["p"].alias("p"), x["q"].alias("q")))), "paths")
        splitters = splitters_of(paths, total, shards, per_shard)
        rows = saved(finished(dealt(paths, splitters), skeleton_of(splitters)), "finished")
        last = F.element_at("path", -1)
        tails = paths.filter(F.col("length") > last["depth"]).select(
            F.col("conv_id").alias("_id"), "length", last["depth"].alias("under"), last["conv_id"].alias("parent"))
        alone = turns.join(tails, F.col("conv_id") == F.col("_id")).filter("depth > under").select(
            "conv_id", "depth", F.when(F.col("depth") == F.col("under") + 1, F.col("parent")).otherwise(F.col("conv_id")).alias("parent_conv_id"),
            F.lit(1).cast("long").alias("n_convs"), (F.col("depth") < F.col("length")).cast("long").alias("n_children"),
            F.lit(1).cast("long").alias("n_leaves"), F.lit(0).cast("long").alias("saved_tokens"),
            F.when(F.col("depth") == F.col("length"), F.sha2(F.col("conv_id").cast("string").cast("binary"), 256))
            .otherwise(F.lit(NOTHING)).alias("ends_sha256"))
        trie = rows.filter(F.col("kind") == LOCAL).select(*COLUMNS).unionByName(reduced(rows)).unionByName(alone)
        return saved(trie, "trie", keep=True)
