import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tokenloom.llm import topk

SCHEMA = "vec_id long, embedding array<double>, row string, ids int, score string, rank int, vec string"


def brute(rows, asked, k=topk.K):
    """All scores of every query row, best first."""
    usable = [(i, v) for i, v in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    whole = [(i, [math.floor(1024 * x) if abs(x) < 2**53 else int(x) * 1024 for x in v]) for i, v in usable]
    out = []
    for a, (i, v) in enumerate(whole):
        if i is None or not asked(i):
            continue
        scores = [(-min(max(sum(x * y for x, y in zip(v, w)), -(2**124)), 2**124), j is None, j or 0) for b, (j, w) in enumerate(whole) if a != b]
        out += [(i, r + 1, None if none else j, max(min(-s, 2**63 - 1), -(2**63))) for r, (s, none, j) in enumerate(sorted(scores)[:k])]
    return sorted(out, key=repr)


def found(spark, rows, k=topk.K, kind=SCHEMA, every=100, **more):
    frame = spark.createDataFrame([(i, v, "r", 1, "s", 2, "v") for i, v in rows], kind)
    return sorted(map(tuple, topk.top_k(frame, F.col("vec_id") % every == 0, k, **more).collect()), key=repr)


def test_awkward_vectors(spark):
    rng = random.Random(4)
    vector = lambda n=6: [rng.choice([-1.5, -0.25, 0.0, 0.1, 0.7, 2.0]) for _ in range(n)]
    rows = [(i, vector()) for i in range(0, 420, 3)]
    rows += [(1, None), (2, [1.0, None]), (4, [float("nan")]), (5, [float("inf"), 1.0]), (200, None)]
    rows += [(700, []), (800, [0.5]), (None, vector()), (None, vector(9)), (900, vector(9)), (900, vector(9)), (0, vector())]
    rows += [(i, [0.7] * 6) for i in range(1000, 1030)]  # copies: ties by id
    assert found(spark, rows) == brute(rows, lambda i: i % 100 == 0)
    assert found(spark, rows, 3, pivots=2) == brute(rows, lambda i: i % 100 == 0, 3)


def test_few_rows(spark):
    assert found(spark, []) == []
    assert found(spark, [(100, [1.0])]) == []
    assert found(spark, [(100, [1.0]), (7, [2.0]), (200, [-1.0])]) == brute([(100, [1.0]), (7, [2.0]), (200, [-1.0])], lambda i: i % 100 == 0)
    assert found(spark, [(100, None), (200, [])]) == []


def test_large_numbers_are_exact(spark):
    rows = [(100, [2.0**52, 3.0]), (1, [2.0**40, 1.0]), (2, [2.0**40, 1.001]), (3, [2.0**60, 0.0]), (200, [1e300, -1e300]), (4, [1e10, 1e10])]
    assert found(spark, rows) == brute(rows, lambda i: i % 100 == 0)


def test_floats_in_several_blocks(spark):
    rng = np.random.default_rng(3)
    table = rng.normal(size=(5000, 8)).astype("float32")
    table[3000:] = table[3000:] * 0.1 + 3  # a cluster, so that whole blocks fall away
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(table)]
    kind = SCHEMA.replace("array<double>", "array<float>")
    got = found(spark, rows, kind=kind, every=250)
    assert got == brute(rows, lambda i: i % 250 == 0)


@pytest.mark.parametrize("exact", [np.float64, object])
def test_reading_stops_early(exact):
    rng = np.random.default_rng(5)
    table = np.floor(rng.normal(size=(600, 5)) * 1000).astype(exact)
    table[:100] = table[0]
    places = np.argsort(table.astype(float), axis=0, kind="stable").T
    values = np.take_along_axis(table.T, places, 1)
    for q in range(40):
        query = np.floor(rng.normal(size=7) * 50).astype(exact)
        query[rng.integers(0, 7)] = 0
        scores = (table * query[:5]).sum(axis=1)
        own = int(rng.integers(-1, 600))
        others = np.arange(600) != own
        best = np.sort(scores[others])[-10]
        for floor in (None, best, best + 1):
            left, got = topk.search_block(values, places, table, query, 10, floor, own)
            want = set(np.flatnonzero(others & (scores >= (best if floor is None else floor))).tolist())
            assert want <= set(left.tolist()) and own not in left and (got == scores[left]).all()
        # no row of the block can reach a bound far above
        assert len(topk.search_block(values, places, table, query, 10, int(scores.max()) * 100 + 10**9, own)[0]) == 0
