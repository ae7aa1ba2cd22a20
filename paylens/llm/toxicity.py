"""Toxicity: gradient-boosted trees over dense text features, calibrated.

The lexicon is learned: words and word beginnings that stand in many more toxic
than other labelled texts (smoothed log-odds of document counts, a least
support).  Features of a text: densities of lexicon hits, of their weights, of
second-person words and of hits near them, capitals, punctuation, and obfuscated
words, which are decoded before they are looked up.  Trees are fitted by Spark
ML; isotonic regression on labelled rows that neither lexicon nor trees have
seen turns their margin into a probability.

Only labelled rows of which crc32(doc_id as text) mod 5 is not 0 are learned
from: 1 to 3 fit lexicon and trees, 4 calibrates.  The trees see each of folds 1
to 3 through a lexicon of the other two, so an entry is never scored on the
texts it came from.  Of more than ``max_rows`` labels, about so many are used,
by hash of the doc_id; the lexicon keeps its ``max_entries`` strongest entries.
Every document is scored.  Labels, language, source and doc_id are no features.

Defined results: a null or empty text has features 0 and is scored like any
other; a null doc_id has no label and is not held out; rows that repeat a
doc_id are scored by their own texts; conflicting labels count as toxic;
without labels of both kinds every score is 0; an empty table gives an empty
result; other columns of the input are ignored.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paylens.llm.common import hashed_sample, saved, temporary

SECOND = frozenset("you your yours yourself u ur tu toi te ton ta tes vous votre vos du dich dir dein deine ihr euch "
                   "usted tú ti tus vosotros".split())
# Look-alike characters in obfuscated words.
LOOK = str.maketrans("013457@$!|", "oieastasii")
NEAR = 5
BEGINNINGS = range(3, 7)
SUPPORT = 4
ODDS = 2.5
FOLDS = (1, 2, 3)
FEATURES = ("words", "hits", "hit_count", "hit_kinds", "weight", "best_weight", "second", "hits_near_second", "capitals",
            "capital_words", "punctuation", "exclamations", "repeated_punctuation", "obfuscated", "obfuscated_hits",
            "digits", "word_length")
_EDGES = ".,;:!?\"'()[]{}<>|*#$%&-_~`«»¿¡…"
_OPENING = _EDGES.translate({ord(c): None for c in "$!|"})  # a look-alike can be the first letter
_MASKED = re.compile(r"[^\W\d_][\d@$!|*#%&]+[^\W\d_]")
_MARKS = re.compile(r"[*#%&]")
_LONGEST = 64  # code points of a word that are looked at

# classes of characters, up to the last one that is told apart
_UPPER, _LETTER, _DIGIT, _MARK, _STRONG = 1, 2, 4, 8, 16
_CLASS = np.array([_UPPER * chr(k).isupper() + _LETTER * chr(k).isalpha() + _DIGIT * chr(k).isdigit() + _MARK * (chr(k) in _EDGES)
                   + _STRONG * (chr(k) in "!?.*#$%&") for k in range(0x2027)] + [_LETTER], dtype=np.uint8)


def decoded(word: str) -> tuple[str, bool]:
    """A word in lower case without its edges and leading digits, look-alikes
    inside it replaced and marks taken out; and whether there were any."""
    low = word[:_LONGEST].strip(_EDGES).lower()
    if low.isalpha():
        return low, False
    whole = word[:_LONGEST].lower().rstrip(_EDGES).lstrip(_OPENING)
    if _MASKED.search(whole):
        return _MARKS.sub("", whole.translate(LOOK)), True
    return low.lstrip("0123456789").strip(_EDGES), False


def entries_of(low: str) -> Iterator[str]:
    """What of a decoded word can be in the lexicon: its beginnings, and (marked by a blank) all of it."""
    for k in BEGINNINGS:
        if k <= len(low):
            yield low[:k]
    if low:
        yield low + " "


def spelled(words: list[str]) -> Iterator[str]:
    """Words written letter by letter: three or more single letters in a row."""
    run: list[str] = []
    for word in [*words, ""]:
        if len(word) == 1 and word.isalpha():
            run.append(word)
        else:
            if len(run) > 2:
                yield "".join(run[:_LONGEST])
            run = []


def features(text: str, lexicon: dict[str, float] | None = None, memo: dict | None = None) -> list[float]:
    """The dense features of a text, in the order of ``FEATURES``.  memo: what is known of words (of one lexicon)."""
    raw = text.split()
    if not raw:
        return [0.0] * len(FEATURES)
    lexicon, memo = lexicon or {}, {} if memo is None else memo
    n = len(raw)
    hits, second, weight, best, masked, hidden, capital = [], [], 0.0, 0.0, 0, 0, 0
    kinds = set()
    for k, word in enumerate([*raw, *spelled(raw)]):
        known = memo.get(word)
        if known is None:
            low, mask = decoded(word)
            known = (max(map(lexicon.get, entries_of(low), iter(lambda: 0.0, None)), default=0.0), low in SECOND, mask,
                     len(word) > 1 and word.isupper(), low)
            known = known if known[0] or any(known[1:4]) else ()
            if len(word) <= _LONGEST:
                if len(memo) > 200_000:
                    memo.clear()
                memo[word] = known
        if known:
            if known[0]:
                hits.append(min(k, n))
                weight += known[0]
                best = max(best, known[0])
                kinds.add(known[4])
                hidden += known[2]
            if known[1]:
                second.append(k)
            masked += known[2]
            capital += known[3]
    near = at = 0
    for k in hits:
        while at < len(second) and second[at] < k - NEAR:
            at += 1
        near += at < len(second) and second[at] <= k + NEAR
    codes = np.frombuffer(text.encode("utf-32-le", "replace"), dtype=np.uint32)
    kind = _CLASS[np.minimum(codes, len(_CLASS) - 1)]
    letters = int((kind & _LETTER > 0).sum())
    strong = kind & _STRONG > 0
    twice = strong[1:] & strong[:-1]
    repeated = int(twice[:1].sum() + (twice[1:] & ~twice[:-1]).sum())
    return [
        math.log1p(n), len(hits) / n, math.log1p(len(hits)), float(len(kinds)), weight / n, best, len(second) / n, near / n,
        int((kind & _UPPER > 0).sum()) / max(1, letters), capital / n, int((kind & _MARK > 0).sum()) / len(codes),
        text.count("!") / n, repeated / n, masked / n, float(hidden), int((kind & _DIGIT > 0).sum()) / len(codes), letters / n]


def fold(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string")) % 5


def labelled(docs: DataFrame, labels: DataFrame, max_rows: int) -> DataFrame:
    """doc_id, text, label, fold of the rows that are learned from."""
    marks = (labels.groupBy(F.col("doc_id").cast("long").alias("_id")).agg(F.max("toxic").alias("label"))
             .filter(F.col("label").isNotNull() & (fold(F.col("_id")) != 0)))
    marks = hashed_sample(marks, "_id", marks.count(), max_rows)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    # about ``max_rows`` narrow rows at most: small enough for every task, so no text is shuffled
    return texts.join(F.broadcast(marks), F.col("doc_id") == F.col("_id")).select(
        "doc_id", "text", F.col("label").cast("double"), fold(F.col("doc_id")).alias("fold"))


def entry_counts(rows: DataFrame) -> DataFrame:
    """entry, and n{fold}{label}: texts of each fold and label that hold it."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text, label, part in zip(*batch.columns, strict=True):
                raw = (text.as_py() or "").split()
                held = {e for w in {*raw, *spelled(raw)} for e in entries_of(decoded(w)[0])}
                if held:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(held, pa.string()), pa.array([label.as_py()] * len(held), pa.float64()),
                         pa.array([part.as_py()] * len(held), pa.int64())], ["entry", "label", "fold"])

    listed = rows.select("text", "label", "fold").mapInArrow(scan, "entry string, label double, fold long")
    return listed.groupBy("entry").agg(*[F.count(F.when((F.col("fold") == f) & (F.col("label") == y), 1)).alias(f"n{f}{y}")
                                         for f in FOLDS for y in (0, 1)])


def lexicons(rows: DataFrame, max_entries: int, support: int = SUPPORT, odds: float = ODDS) -> dict[int, dict[str, float]]:
    """The lexicon without each of the folds, and under 0 that of all folds: entry and its log-odds."""
    texts = {(r["fold"], int(r["label"])): r["count"] for r in rows.groupBy("fold", "label").count().collect()}  # eight rows
    counts = entry_counts(rows.filter(F.col("fold").isin(*FOLDS)))
    out = {}
    weights = {}
    for without in (0, *FOLDS):
        used = [f for f in FOLDS if f != without]
        toxic, other = (sum((F.col(f"n{f}{y}") for f in used), F.lit(0)) for y in (1, 0))
        all_toxic, all_other = (sum(texts.get((f, y), 0) for f in used) for y in (1, 0))
        weight = F.log((toxic + 0.5) / (all_toxic + 1)) - F.log((other + 0.5) / (all_other + 1))
        weights[without] = F.when(toxic + other >= support, weight).otherwise(0.0)
    found = counts.select("entry", *[w.alias(f"w{f}") for f, w in weights.items()])
    found = found.filter(F.greatest(*[F.col(f"w{f}") for f in weights]) > odds)
    found = found.orderBy(F.greatest(*[F.col(f"w{f}") for f in weights]).desc(), "entry").limit(max_entries).collect()
    for f in weights:
        out[f] = {r["entry"]: r[f"w{f}"] for r in found if r[f"w{f}"] > odds}
    return out


def document_features(docs: DataFrame, known: dict[int, dict[str, float]], part: Column, columns: list[str]) -> DataFrame:
    """``columns`` and ``features`` (an array) of every document; ``part`` chooses the lexicon."""
    shared = docs.sparkSession.sparkContext.broadcast(known)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memos: dict[int, dict] = {f: {} for f in shared.value}
        for batch in batches:
            rows = [features(t.as_py() or "", shared.value[f], memos[f])
                    for t, f in zip(batch.column(0), batch.column(1).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns[2:], pa.array(rows, pa.list_(pa.float64()))], [*columns, "features"])

    rows = docs.select("text", part.cast("int").alias("_part"), *columns)
    kinds = ", ".join(f"{c} {t}" for c, t in rows.dtypes[2:])
    return rows.mapInArrow(scan, f"{kinds}, features array<double>")


def learned(sample: DataFrame, known: dict[int, dict[str, float]], trees: int, depth: int):
    """The fitted trees and the calibration; None if a class is missing."""
    other = F.when(F.col("fold").isin(*FOLDS), F.col("fold")).otherwise(0)
    rows = saved(document_features(sample, known, other, ["label", "fold"]), "labelled")
    rows = rows.withColumn("vector", array_to_vector("features"))
    fit, check = rows.filter("fold < 4"), rows.filter("fold = 4")
    if fit.select("label").distinct().count() < 2:
        return None
    if check.select("label").distinct().count() < 2:
        check = fit
    model = GBTClassifier(featuresCol="vector", labelCol="label", maxIter=trees, maxDepth=depth, stepSize=0.2,
                          minInstancesPerNode=5, seed=1, maxMemoryInMB=64).fit(fit.coalesce(2))
    level = IsotonicRegression(featuresCol="margin", labelCol="label", predictionCol="score").fit(
        margins(model, check).select("margin", "label"))
    return model, level


def margins(model, rows: DataFrame) -> DataFrame:
    return model.transform(rows).withColumn("margin", vector_to_array("rawPrediction")[1])


def toxicity(docs: DataFrame, labels: DataFrame, max_rows: int = 50_000, trees: int = 16, depth: int = 3,
             max_entries: int = 5_000) -> DataFrame:
    """doc_id, held_out, score and predicted of every document."""
    with temporary(docs.sparkSession):
        sample = saved(labelled(docs, labels, max_rows), "sample")
        known = lexicons(sample, max_entries)
        models = learned(sample, known, trees, depth)
    rows = docs.select(F.col("doc_id").cast("long"), "text")
    if models is None:
        rows = rows.select("doc_id", F.lit(0.0).alias("score"))
    else:
        rows = document_features(rows, {0: known[0]}, F.lit(0), ["doc_id"]).withColumn("vector", array_to_vector("features"))
        rows = models[1].transform(margins(models[0], rows))
    score = F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.col("score")))
    return rows.select("doc_id", F.coalesce(fold(F.col("doc_id")) == 0, F.lit(False)).alias("held_out"),
                       score.alias("score"), (score >= 0.5).cast("int").alias("predicted"))
