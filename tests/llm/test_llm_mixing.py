import pytest
from llm_plain import awkward
from pyspark.sql import functions as F

from tokenloom.llm import mixing


def filled(sizes, weights, epochs, budget=1.0):
    """Clamp and reshare until nothing changes."""
    total, capped = budget * sum(sizes.values()), set()
    while True:
        rest = total - sum(epochs * sizes[s] for s in capped)
        open_ = {s: w for s, w in weights.items() if s not in capped}
        share = {s: rest * w / sum(open_.values()) for s, w in open_.items()} if open_ else {}
        over = {s for s, t in share.items() if t > epochs * sizes[s]}
        if not over:
            return {s: share.get(s, epochs * sizes[s]) for s in sizes}
        capped |= over


@pytest.mark.parametrize("sizes", [[10, 200, 3000], [1, 1, 1], [500, 1, 40, 7, 900, 0], [0, 5]])
def test_water_filling(spark, sizes):
    names = [f"s{i}" for i in range(len(sizes))]
    cycle = (5, 2, 1)
    weights = {n: cycle[i % 3] for i, n in enumerate(names)}
    table = spark.createDataFrame(list(zip(names, sizes)), "source string, source_size long")
    got = mixing.water_fill(table, mixing.cyclic_weights(table, cycle), 3).collect()
    want = filled(dict(zip(names, sizes)), weights, 3)
    assert {r.source: r.target for r in got} == pytest.approx(want)


def test_counts_meet_targets(spark):
    texts = [" ".join(["w"] * (1 + i * 7 % 23)) for i in range(400)] + [None, ""]
    sources = ["big"] * 300 + ["mid"] * 80 + ["tiny"] * 20 + [None, None]
    docs = awkward(spark, texts, sources)
    rows = mixing.mix_counts(docs, (1, 4, 4)).collect()
    for source in {r.source for r in rows}:
        own = [r for r in rows if r.source == source]
        assert abs(sum(r.size * r.repeats for r in own) - own[0].target) <= 12
        assert max(r.repeats for r in own) <= 3
    assert rows and sorted(rows, key=str) == sorted(mixing.mix_counts(docs, (1, 4, 4)).collect(), key=str)
    assert sorted((r.id, r.repeats) for r in rows) != sorted((r.id, r.repeats) for r in mixing.mix_counts(docs, (1, 4, 4), seed=5).collect())
    mixed = mixing.mix(docs, (1, 4, 4))
    assert mixed.columns == docs.columns
    taken = {r.doc_id: r["count"] for r in mixed.groupBy("doc_id").count().collect()}
    assert taken == {r.id: r.repeats for r in rows if r.repeats}


def test_weights_as_table_and_null_weight(spark):
    docs = awkward(spark, ["a b c", "d e", "f"], ["x", "y", "z"])
    weights = spark.createDataFrame([("x", 1.0), ("y", None)], "source string, weight double")
    rows = {r.source: r for r in mixing.mix_counts(docs, weights).collect()}
    assert rows["x"].target == 6 and rows["x"].repeats == 2
    assert rows["y"].repeats == rows["z"].repeats == 0


def test_empty_table_and_no_words(spark):
    docs = awkward(spark, ["a"])
    assert mixing.mix_counts(docs.limit(0), (5, 2, 1)).count() == 0
    assert [r.target for r in mixing.mix_counts(docs.withColumn("text", F.lit(None).cast("string")), (5, 2, 1)).collect()] == [0.0]
