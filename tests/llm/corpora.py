"""Small corpora for the tests, and brute-force near duplicates."""

import random

from pyspark.sql import functions as F

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"
# names that operators use for themselves
CLASH = ("content", "n", "class", "group", "key", "token", "hash", "size", "row", "words", "start", "length", "doc",
         "left", "kept", "host", "score", "component", "take", "d", "a", "b", "changed", "touched")


def frame(spark, texts, ids=None, sources=None, clash=False):
    ids = list(range(len(texts))) if ids is None else ids
    sources = [f"s{k % 2}" for k in range(len(texts))] if sources is None else sources
    rows = [(i, t, None, s, None if t is None else len(t)) for i, t, s in zip(ids, texts, sources, strict=True)]
    df = spark.createDataFrame(rows, COLUMNS)
    return df.withColumns({c: F.lit("x") for c in CLASH}) if clash else df


def prose(rng, n, size=3000):
    return " ".join(f"w{int(rng.paretovariate(0.3)) % size}" for _ in range(n))


def corpus(seed, n=40, lengths=(1, 120)):
    """Unrelated texts, families of near copies, exact copies, and a passage in many texts."""
    rng = random.Random(seed)
    passage = prose(rng, 30)
    out = []
    for _ in range(n):
        text = prose(rng, rng.randint(*lengths))
        out.append(text)
        for _ in range(rng.choice((0, 0, 0, 1, 6))):
            words = text.split()
            for _ in range(rng.randint(0, 2)):
                words[rng.randrange(len(words))] = f"e{rng.randrange(50)}"
            out.append(" ".join(words))
        if rng.random() < 0.5:
            out[-1] = out[-1] + " " + passage + " " + prose(rng, rng.randint(0, 5))
    rng.shuffle(out)
    return out


EDGES = [None, "", "  \n\t ", "one", "one", "Two words", "a b c d e", "A B C D E", "x " * 30, "x " * 30,
         "é ñ \u2003 ü\u00a0y", "longword" * 2000, "long text " * 5000, None]
EDGE_IDS = [5, None, 3, 3, 3, 7, 8, None, 10, 10, 11, 12, 13, 14]
EDGE_SOURCES = [None, "s", None, "s", "s", "t", "t", "t", "u", "u", "u", "u", "s", "s"]


def edges(spark, clash=True):
    return frame(spark, EDGES, EDGE_IDS, EDGE_SOURCES, clash)


def empty(spark):
    return spark.createDataFrame([], COLUMNS)


def shingle_sets(texts):
    out = []
    for t in texts:
        w = (t or "").encode().lower().split()
        out.append({tuple(w[k:k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set()))
    return out


def linked(texts):
    """Component of every text: the least index reachable by links."""
    sets = shingle_sets(texts)
    parent = list(range(len(texts)))

    def find(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for i, x in enumerate(sets):
        for j in range(i):
            both = len(x & sets[j])
            if x and sets[j] and 100 * both >= 80 * (len(x) + len(sets[j]) - both):
                a, b = sorted((find(i), find(j)))
                parent[b] = a
    return [find(k) for k in range(len(texts))], sets
