import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from tokenloom.llm import lexical

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def brute(items, docs, k=10):
    counts = [(i, Counter(terms(t))) for i, t in docs]
    filled = [(i, c) for i, c in counts if c]
    n, length = len(filled), sum(sum(c.values()) for _, c in filled)
    held = Counter(t for _, c in filled for t in c)
    weight = {t: math.floor(1000 * math.log((2 * n + 2) / (2 * df + 1))) for t, df in held.items()}
    out = []
    for item, text in items:
        scored = []
        for i, c in filled:
            m = 10 + 90 * sum(c.values()) * n // length
            score = sum(weight[t] * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t in set(terms(text)) if t in c)
            if score > 0:
                scored.append((-score, i is None, i or 0))
        out += [(item, r + 1, None if none else i, -s) for r, (s, none, i) in enumerate(sorted(scored)[:k])]
    return sorted(out, key=repr)


def found(spark, items, docs, **more):
    kind = "{id} long, text string, item int, n string, terms string, tf int, score int, rank int, g int"
    frames = [spark.createDataFrame([(i, t, 1, "n", "t", 2, 3, 4, 5) for i, t in rows], kind.format(id=id)) for id, rows in (("item_id", items), ("doc_id", docs))]
    return sorted(map(tuple, lexical.search(*frames, **more).collect()), key=repr)


@pytest.fixture(scope="module")
def tables():
    rng = random.Random(8)
    words = [f"w{n}" for n in range(60)] + ["ÉTÉ", "été", "中文", "a1", "A1", "straße"]
    weights = [1 / (n + 1) for n in range(len(words))]
    text = lambda n: rng.choice([" ", ".", "_", "-\n"]).join(rng.choices(words, weights, k=n))
    docs = [(n, text(rng.choice([0, 1, 5, 40, 120]))) for n in range(400)]
    docs += [(None, None), (500, None), (501, ""), (502, "?!"), (None, text(9)), (600, text(4000)), (3, text(30)), (3, text(30))]
    docs += [(n, "same words here w1 w2") for n in range(700, 730)]
    items = [(n, text(rng.choice([1, 8, 30]))) for n in range(25)] + [(90, None), (91, ""), (92, "nothing known"), (7, text(5)), (None, text(5)), (93, "words same"), (94, "x" * 3000)]
    return items, docs


def test_equals_brute_force(spark, tables):
    assert found(spark, *tables) == brute(*tables)


def test_groups_of_items(spark, tables):
    """More terms than a group takes: several passes, the same result."""
    items, docs = tables[0][:12], tables[1][:120]
    assert found(spark, items, docs, vocabulary=25, k=4) == brute(items, docs, 4)


def test_empty_tables(spark, tables):
    items, docs = tables
    assert found(spark, [], docs) == [] and found(spark, items, []) == [] and found(spark, items, [(1, None)]) == []


def test_tree_prunes_and_misses_nothing():
    rng = np.random.default_rng(2)
    rows = []
    for topic in range(12):
        for _ in range(150):
            columns = np.unique(np.r_[rng.integers(topic * 40, topic * 40 + 40, 20), rng.integers(480, 500, 5)])
            rows.append((columns, rng.integers(1, 10**6, len(columns))))
    offsets = np.r_[0, np.cumsum([len(c) for c, _ in rows])]
    docs = lexical.Sparse(offsets, np.concatenate([c for c, _ in rows]), np.concatenate([v for _, v in rows]))
    tree, opened = lexical.BallTree(docs, 600), 0
    times = lexical.Sparse.times

    def counted(self, dense, first=0, last=None):
        nonlocal opened
        opened += last is not None
        return times(self, dense, first, last)

    for _ in range(30):
        topic = int(rng.integers(0, 12))
        query = np.unique(np.r_[rng.integers(topic * 40, topic * 40 + 40, 15), rng.integers(480, 600, 3)])
        weight = rng.integers(0, 20_000, len(query))
        dense = np.zeros(600, np.int64)
        dense[query] = weight
        want = docs.times(dense)
        lexical.Sparse.times = counted
        try:
            places, scores = tree.search(query, weight, 10, 1)
        finally:
            lexical.Sparse.times = times
        best = max(int(np.sort(want)[-10]), 1)
        assert sorted(places.tolist()) == np.flatnonzero(want >= best).tolist() and (scores == want[places]).all()
    leaves = sum(n[3] < 0 for n in tree.nodes)
    assert opened < 30 * leaves * 0.65  # the others are never scored
