"""Spelling variants, conversation trie and SimHash against plain Python, and their edge cases."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from corpora import corpus, edges, empty, frame
from pyspark.sql import functions as F

from paylens.llm import conversation_trie, simhash, spelling

# ------------------------------------------------------------ spelling variants

LETTERS = "abcdeé"


def vocabulary(rng, n):
    """Words, their variants by one and two edits, and how often they occur."""
    out = []
    for _ in range(n):
        word = "".join(rng.choices(LETTERS, k=rng.randint(4, 9)))
        out += [word] * rng.randint(1, 30)
        for _ in range(rng.randint(0, 4)):
            at = rng.randrange(len(word))
            word = rng.choice((word[:at] + word[at + 1:], word[:at] + rng.choice(LETTERS) + word[at:],
                               word[:at] + rng.choice(LETTERS) + word[at + 1:]))
            out += [word] * rng.randint(1, 9)
    rng.shuffle(out)
    return out


def one_edit(x, y):
    if len(x) == len(y):
        return sum(a != b for a, b in zip(x, y, strict=True)) == 1
    x, y = sorted((x, y), key=len)
    return len(y) == len(x) + 1 and any(y[:k] + y[k + 1:] == x for k in range(len(y)))


def variants(docs):
    total = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            total[run] += 1
    total = {w: n for w, n in total.items() if len(w) >= 5 and n >= 3}
    near = {w: [x for x in total if one_edit(w, x)] for w in total}
    best = {w: min(xs, key=lambda x: (-total[x], x)) if xs else None for w, xs in near.items()}
    form = {w: x if x and total[x] >= 2 * total[w] else None for w, x in best.items()}

    def root(w):
        while form[w]:
            w = form[w]
        return w

    return {(w, form[w], root(w), n, len(near[w]), total[form[w]] if form[w] else None) for w, n in total.items()}


@pytest.mark.parametrize("cell,sample", [(4096, 100_000), (20, 100_000), (20, 60), (1, 100_000)])
def test_spelling_variants_equal_brute_force(spark, cell, sample):
    rng = random.Random(cell + sample)
    words = vocabulary(rng, 150)
    texts = [" ".join(words[k:k + 40]) for k in range(0, len(words), 40)]
    texts[3] = texts[3].upper()
    got = spelling.spelling_variants(frame(spark, texts, clash=True), cell=cell, sample=sample)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    rows = list(map(tuple, got.collect()))
    assert len(rows) == len(set(rows)) and set(rows) == variants(enumerate(texts))


def test_spelling_edges(spark):
    long = "x" * 100_000
    texts = [None, "", " 12 !", "Äpfel äpfel Äpfel", "naïve naïve naïves", "naïve, naïve; NAïVE",
             f"{long} {long}a", f"{long} {long}a {long}", f"{long}a"]
    ids = [1, 2, None, None, 5, 5, 7, 8, 9]
    rows = set(map(tuple, spelling.spelling_variants(frame(spark, texts, ids)).collect()))
    assert rows == variants(zip(ids, texts, strict=True))
    assert spelling.spelling_variants(empty(spark)).count() == 0
    assert spelling.spelling_variants(edges(spark)).columns[0] == "word"


def test_trees_hold_every_point_once_and_visits_miss_none():
    rng = np.random.default_rng(3)
    points = rng.poisson(0.4, (500, spelling.LETTERS)).astype(np.float32)
    tree, leaves = spelling.grown(points, 20)
    own = {leaf: set(at.tolist()) for leaf, at in spelling.visits(tree, points, 0, 0)}
    assert sum(map(len, own.values())) == 500 and len(own) == leaves
    assert max(map(len, own.values())) <= 20
    query = points + 0
    query[:, 3] += 1
    reached = {leaf: set(at.tolist()) for leaf, at in spelling.visits(tree, query, 0, 1)}
    assert all(own[leaf] <= reached.get(leaf, set()) for leaf in own)


# ------------------------------------------------------------ conversation trie

SCHEMA = "conv_id long, turn long, role string, text string"


def trie(rows):
    """The nodes by the definition. rows: (conv_id, turn, role, text)."""
    turns = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            turns[c].append((turn is not None, turn or 0, role or "", text or ""))
    turns = {c: [(r, t) for *_, r, t in sorted(v, key=lambda x: x[:2])] for c, v in turns.items()}
    built = {}
    for c in turns:
        h = zlib.crc32(str(c).encode()) % 4
        built[c] = tuple(turns.get(c - c % 20, [])[:h] + turns[c][h:])
    members = defaultdict(set)
    for c, path in built.items():
        for d in range(len(path) + 1):
            members[path[:d]].add(c)
    children = defaultdict(set)
    for path in members:
        if path:
            children[path[:-1]].add(path)

    def below(path):
        yield path
        for child in children[path]:
            yield from below(child)

    out = set()
    for path, who in members.items():
        nodes = list(below(path))
        ends = sorted(c for c in who if len(built[c]) == len(path))
        out.add((min(who), len(path), min(members[path[:-1]]) if path else None, len(who), len(children[path]),
                 sum(not children[x] for x in nodes),
                 sum((len(members[x]) - 1) * (len(x[-1][1].encode().split()) if x else 0) for x in nodes),
                 hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()))
    return out


def conversations(rng, n):
    rows = []
    pool = [[("user" if k % 2 else "system", f"turn {rng.randrange(4)} of it") for k in range(rng.randint(1, 6))] for _ in range(8)]
    for c in rng.sample(range(400), n):
        path = list(rng.choice(pool))
        if rng.random() < 0.4:
            path[rng.randrange(len(path)):] = [("user", f"word {rng.randrange(99)}")] * rng.randint(0, 3)
        rows += [(c, k, r, t) for k, (r, t) in enumerate(path)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("shards,per_shard", [(1, 4), (3, 2), (8, 32), (64, 8)])
def test_trie_equals_brute_force(spark, shards, per_shard):
    rows = conversations(random.Random(shards), 150)
    table = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit(1) for c in ("depth", "p", "tokens", "place", "path")})
    got = conversation_trie.prefix_trie(table, shards, per_shard)
    assert got.columns == conversation_trie.COLUMNS
    found = list(map(tuple, got.collect()))
    assert len(found) == len(set(found)) and set(found) == trie(rows)


def test_a_crowd_of_copies_spans_many_shards(spark):
    rows = [(20 * c, k, "user", f"the same {k}") for c in range(300) for k in range(3)]
    rows += [(20 * c, k, "user", f"the same {k}") for c in range(300, 310) for k in range(2)]
    got = set(map(tuple, conversation_trie.prefix_trie(spark.createDataFrame(rows, SCHEMA), 16, 8).collect()))
    assert got == trie(rows)


def test_trie_edges(spark):
    rows = [(0, None, None, None), (0, 1, "user", "a b"), (0, 0, "", ""), (1, 5, "user", ""), (3, 0, "u", "x y z"), (3, 1, None, "q"),
            (None, 0, "user", "lost"), (45, 2, "user", "late"), (45, None, "user", "first"), (40, 1, "user", "one"),
            (7, 0, "user", "long " * 50_000), (7, 1, "user", "end")]
    rows += [(60, k, "user", f"step {k}") for k in range(400)] + [(80, k, "user", f"step {k}") for k in range(400)]
    got = set(map(tuple, conversation_trie.prefix_trie(spark.createDataFrame(rows, SCHEMA)).collect()))
    assert got == trie(rows)
    assert conversation_trie.prefix_trie(spark.createDataFrame([], SCHEMA)).count() == 0
    one = [(4, 0, "user", "alone here")]
    assert set(map(tuple, conversation_trie.prefix_trie(spark.createDataFrame(one, SCHEMA)).collect())) == trie(one)


# ------------------------------------------------------------ SimHash

def simhash_of(text):
    words = (text or "").encode().lower().split()
    parts = [b" ".join(words[k:k + 3]) for k in range(max(1, len(words) - 2))] if words else []
    h = [xxhash.xxh64_intdigest(p, 42) for p in parts]
    return sum(1 << k for k in range(64) if 2 * sum(x >> k & 1 for x in h) > len(h))


def groups(prints):
    parent = {p: p for p in prints}

    def find(k):
        while parent[k] != k:
            k = parent[k]
        return k

    every = sorted(parent)
    for k, x in enumerate(every):
        for y in every[:k]:
            if (x ^ y).bit_count() <= 2:
                parent[find(x)] = find(y)
    return {p: find(p) for p in every}


def test_simhash_components_equal_brute_force(spark):
    texts = corpus(5, 60) + ["", None, "a", "a b", "A B"]
    texts += ["x y z " * 40 + w for w in ("x", "y", "q")]
    prints = [simhash_of(t) for t in texts]
    root = groups(prints)
    least = {}
    for k, p in enumerate(prints):
        least.setdefault(root[p], k)
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"])
           for r in simhash.simhash_components(frame(spark, texts, clash=True)).collect()}
    assert got == {k: (f"{p:016x}", least[root[p]]) for k, p in enumerate(prints)}


@pytest.mark.parametrize("few", [1, 2, 16])
def test_links_of_crowded_buckets_are_exact(spark, few):
    rng = random.Random(few)
    prints = set()
    for _ in range(12):
        base = rng.getrandbits(64)
        for _ in range(40):
            p = base
            for bit in rng.sample(range(64), rng.randint(0, 3)):
                p ^= 1 << bit
            prints.add(p)
    root = groups(prints)
    rows = spark.createDataFrame([(simhash._signed(p),) for p in prints], "print long")
    links = simhash.covered_links(rows, few).collect()
    assert all(((r["a"] ^ r["b"]) % 2**64).bit_count() <= 2 for r in links)
    parent = {p: p for p in prints}

    def find(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for r in links:
        parent[find(r["a"] % 2**64)] = find(r["b"] % 2**64)
    assert len({find(p) for p in prints}) == len(set(root.values()))
    assert all((find(p) == find(q)) == (root[p] == root[q]) for p in list(prints)[:60] for q in prints)


def test_masks_cover_every_pair_of_bits():
    tables = [m % 2**64 for m in simhash.masks()]
    assert all(any(not m & (1 << i | 1 << j) for m in tables) for i in range(64) for j in range(64))


def test_simhash_edges(spark):
    rows = [(r["doc_id"], r["fingerprint"], r["component_id"]) for r in simhash.simhash_components(edges(spark)).collect()]
    assert len(rows) == 14
    assert {c for d, f, c in rows if f == "0" * 16} == {3}  # null, empty and blank texts
    assert simhash.simhash_components(empty(spark)).count() == 0
    nulls = frame(spark, ["a b c", "a b c"], [None, None])
    assert [r["component_id"] for r in simhash.simhash_components(nulls).collect()] == [None, None]


def test_a_long_text_is_chunked():
    text = " ".join(f"w{k % 977}" for k in range(150_000))
    words = text.encode().split()
    h = np.array([xxhash.xxh64_intdigest(b" ".join(words[k:k + 3]), 42) for k in range(len(words) - 2)], dtype=np.uint64)
    expected = sum(1 << k for k in range(64) if 2 * int((h >> np.uint64(k) & np.uint64(1)).sum()) > len(h))
    assert simhash.fingerprint(text.encode()) == expected


# ------------------------------------------------------------ scratch tables

def test_scopes_of_two_threads_are_apart(spark):
    import threading

    from paylens.llm.common import saved, temporary

    inside, done, kept = threading.Event(), threading.Event(), []

    def other():
        with temporary(spark):
            kept.append(saved(spark.range(5), "other"))
            inside.set()
            done.wait(60)
            kept.append(kept[0].count())

    thread = threading.Thread(target=other)
    with temporary(spark):
        thread.start()
        inside.wait(60)
    done.set()
    thread.join()
    assert kept[1] == 5
