"""Spelling variants: words one edit apart, found by k-d trees over letter counts.

Words are runs of letters, counted over all documents.  An edit that inserts,
deletes or replaces one letter adds one to at most one letter count and takes
one from at most one: an L1 distance of at most two.  So:

1. For every word length, a skeleton of a k-d tree over letter counts is grown
   from a bounded sample of the words (``sample``).  It only decides which words
   meet in a cell: every word is in exactly one cell of its length, and is a
   query in every cell of its own and of the next length whose box is within
   its reach.  A length of many words is cut into many cells.
2. A cell grows its own k-d tree.  Queries descend as a block, boxes out of
   reach are pruned, and leaves compare counts.
3. What has the right counts is verified letter by letter.

A cell gives one row per query (how many near words, and the best), so the
pairs themselves are never written.  A word's root is found by jumping along
forms; a form has at least twice the occurrences, so chains are short.

Defined results: a null, empty or letterless text has no words; a null doc_id
is written as the empty string before the colon; rows that repeat a doc_id or
a text all count; a run of any length is one word; an empty table, or one
without frequent words, gives an empty result; other columns of the input are
ignored.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paylens.llm.common import hashed_sample, saved, temporary

RUN = re.compile("[a-zÀ-ÿ]+")  # of text whose A-Z are lower-cased
LETTERS = 26 + 64
CELL = 4096
LEAF = 256
SAMPLE = 100_000

# a tree: a leaf's number, or (letter, most, left, right): counts up to ``most`` go left
Tree = "int | tuple[int, int, Tree, Tree]"


# ------------------------------------------------------------ words

def counted_runs(doc_id, text: bytes, least: int) -> Counter:
    """The runs of a text after the rule of deletion, those of ``least`` letters or more."""
    runs = Counter(RUN.findall(text.lower().decode(errors="replace")))
    start = zlib.crc32(b"%d:" % doc_id if doc_id is not None else b":")
    out: Counter = Counter()
    for run, n in runs.items():
        if len(run) < least:
            continue
        h = zlib.crc32(run.encode(), start)
        if h % 97 == 0:
            at = h % len(run)
            run = run[:at] + run[at + 1:]
            if len(run) < least:
                continue
        out[run] += n
    return out


def frequent_words(docs: DataFrame, least: int = 5, times: int = 3) -> DataFrame:
    """word, n: the words of ``least`` code points or more that occur ``times`` times or more."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(total.keys(), pa.string()), pa.array(total.values(), pa.int64())],
                                              ["word", "n"])

        total: Counter = Counter()
        held = 0
        for batch in batches:
            for doc_id, text in zip(*batch.columns, strict=True):
                if not text.is_valid:
                    continue
                total.update(counted_runs(doc_id.as_py(), text.as_py(), least))
                held += text.as_buffer().size
                # at most the words of so much text are held, and what one text adds
                if held > 64_000_000 or len(total) > 400_000:
                    yield rows()
                    total, held = Counter(), 0
        if total:
            yield rows()

    counts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary")).mapInArrow(scan, "word string, n long")
    return counts.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= times)


# ------------------------------------------------------------ k-d trees

def codes_of(words: list[str], length: int) -> np.ndarray:
    """The code points of words of one length, a row each."""
    return np.array(words, dtype=f"<U{length}").view(np.uint32).reshape(len(words), length)


def letter_counts(codes: np.ndarray) -> np.ndarray:
    """How often each letter is in each word (squares of counts are exact, too)."""
    n, length = codes.shape
    letter = np.where(codes < 0xC0, codes - ord("a"), codes - 0xC0 + 26).astype(np.int64)
    letter += np.arange(n)[:, None] * LETTERS
    return np.bincount(letter.ravel(), minlength=n * LETTERS).reshape(n, LETTERS).astype(np.float32 if length < 2000 else np.float64)


def grown(points: np.ndarray, target: float) -> tuple[Tree, int]:
    """A tree whose leaves hold at most ``target`` of the points, as far as their
    counts differ; and the number of leaves.  A node is split where it is cut most evenly."""
    leaves = 0

    def node(at: np.ndarray):
        nonlocal leaves
        if len(at) > target:
            here = points[at]
            half = np.sort(here, axis=0)[(len(at) - 1) // 2]  # medians: lower ones
            best = None
            for most in (half, half - 1):
                left = (here <= most).sum(axis=0)
                even = np.minimum(left, len(at) - left)
                letter = int(even.argmax())
                if even[letter] and (best is None or even[letter] > best[0]):
                    best = (even[letter], letter, int(most[letter]))
            if best is not None:
                _, letter, most = best
                low = here[:, letter] <= most
                return letter, most, node(at[low]), node(at[~low])
        leaves += 1
        return leaves - 1

    return node(np.arange(len(points))), leaves


def visits(tree: Tree, points: np.ndarray, more: int, less: int) -> Iterator[tuple[int, np.ndarray]]:
    """(leaf, indices of points) where a count can be reached by adding at most
    ``more`` letters and taking at most ``less``.  With none of either: each point's leaf."""

    def node(part, at, up, down, low, high):
        # low, high: the box's bounds so far; up, down: letters that each point must add or take to be in it
        if not len(at):
            return
        if not isinstance(part, tuple):
            yield part, at
            return
        letter, most, left, right = part
        value = points[at, letter]
        taken = down + np.maximum(0, value - most) - np.maximum(0, value - high.get(letter, np.inf))
        fits = taken <= less
        yield from node(left, at[fits], up[fits], taken[fits], low, {**high, letter: most})
        added = up + np.maximum(0, most + 1 - value) - np.maximum(0, low.get(letter, -np.inf) - value)
        fits = added <= more
        yield from node(right, at[fits], added[fits], down[fits], {**low, letter: most + 1}, high)

    zero = np.zeros(len(points))
    yield from node(tree, np.arange(len(points)), zero, zero, {}, {})


class Index:
    """A k-d tree over words of one length."""

    def __init__(self, words: list[str], n: np.ndarray, leaf: int = LEAF) -> None:
        order = np.array(sorted(range(len(words)), key=words.__getitem__), dtype=np.int64)
        self.words, self.n = [words[k] for k in order], n[order]  # the smaller word first
        self.length = len(words[0])
        self.codes = codes_of(self.words, self.length)
        self.counts = letter_counts(self.codes)
        self.tree, leaves = grown(self.counts, leaf)
        self.members = [np.empty(0, dtype=np.int64)] * leaves
        for at, points in visits(self.tree, self.counts, 0, 0):
            self.members[at] = points
        self.low = np.array([self.counts[m].min(axis=0) for m in self.members])
        self.high = np.array([self.counts[m].max(axis=0) for m in self.members])
        self.square = (self.counts ** 2).sum(axis=1)

    def near(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(query, point) indices of the words one edit apart: replaced letters
        if the queries have the points' length, else inserted ones."""
        length = len(words[0])
        same = length == self.length
        codes = codes_of(words, length)
        counts = letter_counts(codes)
        square = (counts ** 2).sum(axis=1)
        found = [(np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64))]
        for leaf, at in visits(self.tree, counts, 1, int(same)):
            # the box of the leaf's own points is smaller than the one cut out by the splits
            add = np.maximum(0, self.low[leaf] - counts[at]).sum(axis=1)
            take = np.maximum(0, counts[at] - self.high[leaf]).sum(axis=1)
            at = at[(add <= 1) & (take <= int(same))]
            members = self.members[leaf]
            for part in np.array_split(at, len(at) // 2048 + 1):
                if not len(part):
                    continue
                # counts that differ by +1 and -1 (or by +1) are at a squared distance of 2 (or 1), and no others
                far = square[part, None] + self.square[members] - 2 * (counts[part] @ self.counts[members].T)
                q, p = np.nonzero(far == (2 if same else 1))
                found.append(self._verified(codes, part[q], members[p]))
        return np.concatenate([q for q, _ in found]), np.concatenate([p for _, p in found])

    def _verified(self, codes: np.ndarray, q: np.ndarray, p: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The pairs whose letters are in the right order."""
        length = codes.shape[1]
        keep = [np.empty(0, dtype=bool)]
        for k in range(0, len(q), max(1, 4_000_000 // length)):
            end = k + max(1, 4_000_000 // length)
            x, y = codes[q[k:end]], self.codes[p[k:end]]
            if length == self.length:
                keep.append((x != y).sum(axis=1) == 1)
            else:  # a common start and a common end make up the shorter word
                start = np.logical_and.accumulate(x == y[:, :-1], axis=1).sum(axis=1)
                end_ = np.logical_and.accumulate((x == y[:, 1:])[:, ::-1], axis=1).sum(axis=1)
                keep.append(start + end_ >= length)
        good = np.concatenate(keep)
        return q[good], p[good]


def best_of(q: np.ndarray, p: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per query: how many points, and the one of largest n (the first of equal ones)."""
    order = np.lexsort((p, -n[p], q))
    q, p = q[order], p[order]
    at = np.flatnonzero(np.diff(q, prepend=-1))
    return q[at], np.diff(at, append=len(q)), p[at]


# ------------------------------------------------------------ cells

def skeletons(words: DataFrame, cell: int, sample: int) -> dict[int, Tree]:
    """length: tree of cells, for the lengths that need more than one cell.  The
    sample holds about ``sample`` words at most, so the trees have no more
    nodes; a longer word than 255 code points is not taken."""
    total = words.count()
    some = hashed_sample(words.select("word"), "word", total, sample).filter(F.length("word") < 256).collect()
    by_length: dict[int, list[str]] = {}
    for row in some:
        by_length.setdefault(len(row["word"]), []).append(row["word"])
    target = max(2.0, cell * min(1.0, len(some) / max(1, total)))
    trees = {k: grown(letter_counts(codes_of(v, k)), target) for k, v in by_length.items()}
    return {k: tree for k, (tree, leaves) in trees.items() if leaves > 1}


def in_cells(words: DataFrame, trees: dict[int, Tree]) -> DataFrame:
    """length, cell, query, word, n: every word in its cell (query 0), and as a
    query (1) in all other cells that may hold a word near to it."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, n = batch.column(0).to_pylist(), batch.column(1).to_numpy()
            lengths = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
            for length in np.unique(lengths).tolist():
                at = np.flatnonzero(lengths == length)
                counts = letter_counts(codes_of([texts[k] for k in at], length))
                own = np.empty(len(at), dtype=np.int64)
                for leaf, points in visits(trees.get(length, 0), counts, 0, 0):
                    own[points] = leaf
                parts = [(length, own, 0, np.arange(len(at)))]
                for leaf, points in visits(trees.get(length, 0), counts, 1, 1):
                    parts.append((length, leaf, 1, points[own[points] != leaf]))
                for leaf, points in visits(trees.get(length + 1, 0), counts, 1, 0):
                    parts.append((length + 1, leaf, 1, points))
                rows = at[np.concatenate([points for *_, points in parts])]
                yield pa.RecordBatch.from_arrays(
                    [_column(parts, 0, pa.int32()), _column(parts, 1, pa.int64()), _column(parts, 2, pa.int32()),
                     pa.array([texts[k] for k in rows], pa.string()), pa.array(n[rows], pa.int64())],
                    ["length", "cell", "query", "word", "n"])

    return words.select("word", "n").mapInArrow(scan, "length int, cell long, query int, word string, n long")


def _column(parts: list[tuple], k: int, kind: pa.DataType) -> pa.Array:
    return pa.array(np.concatenate([np.broadcast_to(part[k], len(part[3])) for part in parts]), kind)


def near_in_cells(cells: DataFrame) -> DataFrame:
    """word, n_near, form_n, form: what each cell knows of each word."""

    def answer(index: Index, words: list[str], n: np.ndarray) -> Iterator[pa.RecordBatch]:
        if not words:
            return
        q, p = index.near(words)
        if not len(q):
            return
        yield rows(words, *best_of(q, p, index.n), index.words, index.n)
        if len(words[0]) < index.length:  # the longer word has the shorter one near, too
            order = np.array(sorted(range(len(words)), key=words.__getitem__), dtype=np.int64)
            rank = np.argsort(order)
            yield rows(index.words, *best_of(p, rank[q], n[order]), [words[k] for k in order], n[order])

    def rows(words, q, many, p, others, n) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([words[k] for k in q], pa.string()), pa.array(many, pa.int64()), pa.array(n[p], pa.int64()),
             pa.array([others[k] for k in p], pa.string())], ["word", "n_near", "form_n", "form"])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, index, points, weights = None, None, [], []
        for batch in batches:
            keys = np.stack([batch.column(k).to_numpy() for k in range(3)], axis=1)
            words, n = batch.column(3).to_pylist(), batch.column(4).to_numpy()
            wide = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
            change = (np.diff(keys, axis=0).any(axis=1) | (np.diff(wide) != 0)).nonzero()[0] + 1
            for a, b in zip([0, *change], [*change, len(words)], strict=True):
                if a == b:
                    continue
                if (keys[a, 0], keys[a, 1]) != key:
                    if index is None and points:  # a cell without queries from elsewhere
                        index = Index(points, np.concatenate(weights))
                        yield from answer(index, index.words, index.n)
                    key, index, points, weights = (keys[a, 0], keys[a, 1]), None, [], []
                if keys[a, 2] == 0:
                    points += words[a:b]
                    weights.append(n[a:b])
                elif points:
                    if index is None:
                        index = Index(points, np.concatenate(weights))
                        yield from answer(index, index.words, index.n)
                    yield from answer(index, words[a:b], n[a:b])
        if index is None and points:
            index = Index(points, np.concatenate(weights))
            yield from answer(index, index.words, index.n)

    ordered = cells.repartition("length", "cell").sortWithinPartitions("length", "cell", "query", F.length("word"))
    return ordered.mapInArrow(scan, "word string, n_near long, form_n long, form string")


# ------------------------------------------------------------ forms and roots

def roots(forms: DataFrame) -> DataFrame:
    """word, root of all words that have a form (word, form): the last one reached."""
    known = saved(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        after = known.select(F.col("word").alias("_word"), F.col("root").alias("_root"))
        jumped = saved(known.join(after, F.col("root") == F.col("_word"), "left").select(
            "word", F.coalesce("_root", "root").alias("root"), F.col("_root").isNotNull().alias("moved")), "roots")
        known = jumped.select("word", "root")
        if jumped.filter("moved").isEmpty():
            return known


def spelling_variants(docs: DataFrame, least: int = 5, times: int = 3, cell: int = CELL, sample: int = SAMPLE) -> DataFrame:
    """word, form, root, n, n_near, form_n of every frequent word."""
    with temporary(docs.sparkSession):
        words = saved(frequent_words(docs, least, times), "words")
        cells = in_cells(words, skeletons(words, cell, sample))
        best = near_in_cells(cells).groupBy(F.col("word").alias("_word")).agg(
            F.sum("n_near").alias("n_near"),
            F.min(F.struct((-F.col("form_n")).alias("less"), "form")).alias("best"))
        found = words.join(best, F.col("word") == F.col("_word"), "left").withColumn("form_n", -F.col("best.less"))
        chosen = F.col("form_n") >= 2 * F.col("n")
        table = saved(found.select("word", F.when(chosen, F.col("best.form")).alias("form"), "n",
                                   F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(chosen, F.col("form_n")).alias("form_n")),
                      "variants", keep=True)
        last = saved(roots(table.filter("form is not null")), "last", keep=True)
    return (table.join(last.withColumnRenamed("word", "_word"), F.col("word") == F.col("_word"), "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"))
