import random

import pytest
from llm_plain import awkward, jaccard, shingles
from pyspark.sql import functions as F

from tokenloom.llm import fingerprints as fp


def sketched(spark, texts, k=fp.K):
    return fp.with_sketch(awkward(spark, texts), "text", "sketch", k)


def test_short_equal_and_empty_texts(spark):
    texts = [None, "", " \n\t", "a b", "a  b ", "a b c d e", "a b c d e f", "a b c d e a b c d e a b c d e"]
    rows = sketched(spark, texts).orderBy("doc_id").collect()
    assert [len(r.sketch) for r in rows] == [len(shingles(t)) for t in texts]
    assert rows[3].sketch == rows[4].sketch
    assert all(r.sketch == sorted(set(r.sketch)) for r in rows)


def test_estimates(spark):
    random.seed(1)
    pool = [f"w{i}" for i in range(4000)]
    a = [random.choice(pool) for _ in range(3000)]
    b = a[:2000] + [random.choice(pool) for _ in range(1500)]
    text_a, text_b = " ".join(a), " ".join(b)
    frame = fp.with_sketch(spark.createDataFrame([(text_a, text_b)], "a string, b string"), "a", "sa")
    row = fp.with_sketch(frame, "b", "sb").select(
        fp.resemblance(F.col("sa"), F.col("sb")).alias("j"), fp.containment(F.col("sa"), F.col("sb")).alias("c"),
        fp.distinct_shingles(F.col("sa")).alias("n"), F.size("sa").alias("size"),
    ).first()
    x, y = shingles(text_a), shingles(text_b)
    assert row["size"] == fp.K
    assert row.j == pytest.approx(jaccard(x, y), abs=0.15)
    assert row.c == pytest.approx(len(x & y) / len(x), abs=0.2)
    assert row.n == pytest.approx(len(x), rel=0.3)


def test_merged_sketches_equal_the_sketch_of_all(spark):
    parts = ["a b c d e f g", "c d e f g h i j", "x y z"]
    whole = {s for p in parts for s in shingles(p)}
    merged = fp.merge_sketches(sketched(spark, parts).withColumn("group", F.lit(1)), ["group"], "sketch").first()
    assert len(merged.sketch) == len(whole)
    small = fp.merge_sketches(sketched(spark, parts, 4).withColumn("group", F.lit(1)), ["group"], "sketch", 4).first()
    assert small.sketch == merged.sketch[:4]


def test_empty_sketches_and_table(spark):
    rows = sketched(spark, ["", "a"]).select(fp.resemblance(F.col("sketch"), F.col("sketch")).alias("same")).collect()
    assert [r.same for r in rows] == [1.0, 1.0]
    assert sketched(spark, ["a"]).limit(0).count() == 0


def test_neighbours_form_a_circle(spark):
    docs = awkward(spark, ["x" * i for i in range(50)], ids=[i * i - 40 for i in range(50)])
    rows = {r.id: r for r in fp.neighbours(docs).collect()}
    ids = sorted(rows)
    for n, i in enumerate(ids):
        assert rows[i].next_id == ids[(n + 1) % 50] and rows[i].prev_id == ids[n - 1]
        assert rows[i].prev_chars == (n - 1) % 50
