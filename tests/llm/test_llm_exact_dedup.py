from llm_plain import awkward
from pyspark.sql import functions as F

from tokenloom.llm.exact_dedup import exact_dedup, exact_groups

TEXTS = ["a", "b", None, "", "a", "a ", "A", "b", "long " * 5000, "long " * 5000]


def test_groups(spark):
    rows = {r.id: r for r in exact_groups(awkward(spark, TEXTS)).collect()}
    groups = {i: [j for j, t in enumerate(TEXTS) if (t or "") == (TEXTS[i] or "")] for i in range(len(TEXTS))}
    assert {i: (r.keep_id, r.group_size, r.kept) for i, r in rows.items()} == {i: (g[0], len(g), g[0] == i) for i, g in groups.items()}


def test_largest_and_normalised(spark):
    rows = exact_groups(awkward(spark, TEXTS), keep="largest", normalise=lambda t: F.lower(F.trim(t))).collect()
    assert {r.id: r.keep_id for r in rows}[0] == 6
    assert sum(r.kept for r in rows) == len({(t or "").strip().lower() for t in TEXTS})


def test_collisions_are_told_apart(spark):
    docs = awkward(spark, TEXTS)
    weak = lambda t: F.length(t).cast("string")
    assert sorted(exact_groups(docs, digest=weak).collect()) == sorted(exact_groups(docs).collect())
    assert sorted(r.doc_id for r in exact_dedup(docs, digest=weak).collect()) == [0, 1, 2, 5, 6, 8]


def test_rows_that_stay_keep_their_columns(spark):
    docs = awkward(spark, TEXTS)
    kept = exact_dedup(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [0, 1, 2, 5, 6, 8]


def test_null_and_repeated_ids(spark):
    docs = awkward(spark, ["a", "a", "a", "b", "b"], ids=[None, 3, 3, None, None])
    rows = exact_groups(docs).collect()
    assert sorted((r.keep_id, r.group_size) for r in rows if r.keep_id) == [(3, 3)] * 3
    assert sum(r.kept for r in rows) == 2
    assert sorted(r.text for r in exact_dedup(docs).collect()) == ["a", "b"]


def test_empty_table(spark):
    docs = awkward(spark, TEXTS).limit(0)
    assert exact_groups(docs).count() == 0 and exact_dedup(docs).count() == 0


def test_hot_group_stays_spread(spark):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("text"))
    rows = exact_groups(docs).filter("group_size > 1").select("keep_id", "group_size").distinct().collect()
    assert [tuple(r) for r in rows] == [(0, 1000)]
