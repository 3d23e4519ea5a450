import hashlib
import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tokenloom.operators import batches, ranking


def numbered(spark, n, parts=3):
    return spark.range(0, n, 1, parts).withColumnRenamed("id", "doc_id")


def seeded(ids, seed=17):
    return sorted(ids, key=lambda i: (hashlib.md5(f"{seed}:{i}".encode()).hexdigest(), i))


@pytest.mark.parametrize("n", [1, 5, 6, 7, 11])
def test_chunk_sizes(spark, n):
    df = numbered(spark, n)
    rows = ranking.corpus_chunks(df, 6, ranking.positional_order(df, "doc_id")).collect()
    sizes = Counter(r.chunk for r in rows)
    assert [sizes[i] for i in range(6)] == [n // 6 + (i < n % 6) for i in range(6)]
    ordered = [r.chunk for r in sorted(rows, key=lambda r: r.doc_id)]
    assert ordered == sorted(ordered)


@pytest.mark.parametrize("n", [1, 5, 6, 7, 11])
def test_chunk_compat_repeats_first_rows(spark, n):
    df = numbered(spark, n)
    rows = ranking.corpus_chunks(df, 6, ranking.positional_order(df, "doc_id"), compat=True).collect()
    for chunk in range(6):
        assert sorted(r.doc_id for r in rows if r.chunk == chunk) == list(range(n // 6 + (chunk < n % 6)))


@pytest.mark.parametrize("percent", [0, 30, 50, 100])
def test_chunks_of_a_head(spark, percent):
    df = numbered(spark, 45)
    order = ranking.seeded_order("doc_id")
    both = ranking.corpus_chunks(df, 4, order, percent=percent).collect()
    head = ranking.head_fraction(df, percent, order)
    apart = ranking.corpus_chunks(head, 4, order).collect()
    assert sorted(both) == sorted(apart)
    assert len(both) == round(45 * percent / 100)


def test_head_rounds_half_to_even(spark):
    for n, expected in ((1, 0), (3, 2), (5, 2), (7, 4)):
        df = numbered(spark, n)
        rows = ranking.head_fraction(df, 50, ranking.positional_order(df, "doc_id")).collect()
        assert sorted(r.doc_id for r in rows) == list(range(expected))


def test_positional_order_with_uneven_and_negative_values(spark):
    values = [-5, 0, 1, 2, 3, 1000, 10**12] + list(range(2000, 2600))
    df = spark.createDataFrame([(v,) for v in values], "doc_id long")
    rows = ranking.with_rank(df, ranking.positional_order(df, "doc_id")).collect()
    assert [r.doc_id for r in sorted(rows, key=lambda r: r["rank"])] == sorted(values)


@pytest.mark.parametrize("parts", [1, 16])
def test_order_does_not_depend_on_partitions(spark, parts):
    df = numbered(spark, 500, parts)
    rows = ranking.with_rank(df, ranking.seeded_order("doc_id")).orderBy("rank").collect()
    assert [r.doc_id for r in rows] == seeded(range(500))
    shuffled = ranking.shuffle_rows(df, "doc_id", partitions=parts).collect()
    assert [r.doc_id for r in shuffled] == seeded(range(500))


@pytest.mark.parametrize("digits", [1, 2, 3, 4])
def test_bucket_size_does_not_change_ranks(spark, digits):
    rows = ranking.with_rank(numbered(spark, 300), ranking.seeded_order("doc_id", digits=digits)).orderBy("rank").collect()
    assert [r.doc_id for r in rows] == seeded(range(300))


def test_ranks_before_a_position(spark):
    df = numbered(spark, 300)
    rows = ranking.with_rank(df, ranking.seeded_order("doc_id"), before=40).orderBy("rank").collect()
    assert [r.doc_id for r in rows] == seeded(range(300))[:40]


def skewed(spark):
    """One subset holds most rows, one is smaller than the sample, one has no name."""
    name = F.when(F.col("doc_id") % 50 == 1, "mid").when(F.col("doc_id") < 4, "tiny").when(F.col("doc_id") % 50 == 2, None)
    return numbered(spark, 2000).withColumn("subset", name.otherwise("hot"))


def expected_sample(spark, n):
    groups = {}
    for r in skewed(spark).collect():
        groups.setdefault(r.subset, []).append(r.doc_id)
    return {g: set(seeded(ids)[:n]) for g, ids in groups.items()}


def test_sample_of_listed_subsets(spark):
    rows = ranking.sample_per_subset(skewed(spark), 10, "subset", "doc_id", subsets=["hot", "mid", "tiny", "absent"]).collect()
    expected = expected_sample(spark, 10)
    for g in ("hot", "mid", "tiny"):
        assert {r.doc_id for r in rows if r.subset == g} == expected[g]
    assert {r.subset for r in rows} == {"hot", "mid", "tiny"}


@pytest.mark.parametrize("bound", [10_000, 1])
def test_sample_of_unknown_subsets(spark, monkeypatch, bound):
    """The broadcast and the salted join give the same rows."""
    monkeypatch.setattr(ranking, "BROADCAST_ROWS", bound)
    rows = ranking.sample_per_subset(skewed(spark), 10, "subset", "doc_id").collect()
    found = {}
    for r in rows:
        found.setdefault(r.subset, set()).add(r.doc_id)
    assert found == expected_sample(spark, 10)


def test_salted_join_is_used_beyond_the_bound(spark, monkeypatch):
    monkeypatch.setattr(ranking, "BROADCAST_ROWS", 1)
    frame = ranking.sample_per_subset(skewed(spark), 10, "subset", "doc_id")
    assert "_salt" in frame._jdf.queryExecution().optimizedPlan().toString()


def payload_scans(frame, column="text"):
    """Scans of the payload in the plan as it is first made, before anything is adapted to what runs."""
    plan = frame._jdf.queryExecution().sparkPlan().toString()
    assert not [line for line in plan.splitlines() if "Exchange" in line and column in line]
    return sum(column in line for line in plan.splitlines() if "ReadSchema" in line)


def test_payload_is_not_shuffled(spark):
    """Only key columns cross an exchange, and the text is read by one scan, whatever is adapted at run time."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    place = ranking.positional_order(docs, "doc_id")
    frames = [
        ranking.sample_per_subset(docs, 5, "lang", "doc_id", subsets=["en", "fr"]), ranking.sample_per_subset(docs, 5, "source", "doc_id"),
        ranking.split_exact(docs, 0.05, "doc_id"), ranking.split_exact(docs, 0.05, "doc_id", by="lang"), ranking.head_fraction(docs, 50, place),
        ranking.corpus_chunks(docs, 6, place), ranking.corpus_chunks(docs, 6, ranking.seeded_order("doc_id"), compat=True, percent=50),
    ]
    for frame in frames:
        assert payload_scans(frame) == 1
        frame.collect()
        assert payload_scans(frame) == 1


def test_cuts_are_found_once(spark, monkeypatch):
    """Building a frame finds its cuts; running it twice looks for none again."""
    calls = []
    real = ranking.cut_keys
    monkeypatch.setattr(ranking, "cut_keys", lambda *args, **more: calls.append(1) or real(*args, **more))
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    frame = ranking.split_exact(docs, 0.1, "doc_id", by="lang", subsets=["en", "de"])
    assert frame.count() == frame.count() and len(calls) == 1
    assert "percentile" not in ranking.corpus_chunks(docs, 3, ranking.positional_order(docs, "doc_id"))._jdf.queryExecution().toString()


def test_six_subsets_that_share_ids(spark):
    """Ids are numbered per subset, as in tables made of one dump per language."""
    df = spark.range(150).selectExpr("id % 25 as id", "concat('s', cast(id / 25 as int)) as subset", "concat('t', id) as text")
    half = ranking.corpus_chunks(df, 6, ranking.seeded_order("id"), percent=50).collect()
    assert len(half) == 75 and len({r.text for r in half}) == 75
    assert sorted(Counter(r.chunk for r in half).values()) == [12, 12, 12, 13, 13, 13]
    parts = ranking.split_exact(df, 0.05, "id").collect()
    assert Counter(r.part for r in parts) == {"test": 8, "train": 142} and len({r.text for r in parts}) == 150
    assert sorted(parts) == sorted(ranking.split_exact(df.repartition(7), 0.05, "id").collect())
    assert ranking.head_fraction(df, 33, ranking.positional_order(df, "id")).count() == 50


@pytest.mark.parametrize("identical", [False, True])
def test_ten_copies_of_each_key(spark, identical):
    text = "'same'" if identical else "cast(id as string)"
    df = spark.range(100).selectExpr("id % 10 as key", f"{text} as text", "cast(id % 2 as string) as subset")
    assert ranking.sample_per_subset(df.withColumn("subset", F.lit("a")), 25, "subset", "key", subsets=["a"]).count() == 25
    for subsets in (["0", "1"], None):
        rows = ranking.sample_per_subset(df, 13, "subset", "key", subsets=subsets).collect()
        assert Counter(r.subset for r in rows) == {"0": 13, "1": 13}
    chunks = ranking.corpus_chunks(df, 7, ranking.positional_order(df, "key")).collect()
    assert sorted(Counter(r.chunk for r in chunks).values()) == [14] * 5 + [15] * 2
    ordered = sorted(chunks, key=lambda r: (r.chunk, r.key))
    assert [r.key for r in ordered] == sorted(r.key for r in chunks)
    ranks = ranking.with_rank(df, ranking.seeded_order("key")).collect()
    assert sorted(r.rank for r in ranks) == list(range(100))


@pytest.mark.parametrize("before", [None, 150])
def test_rank_of_a_key_in_many_rows(spark, before):
    """The bucket of a hot key is cut: same ranks, and no task orders more than a small part of its rows."""
    df = spark.range(600).selectExpr("if(id % 2 = 0, 7, id) as key", "concat('t', id) as text")
    order = ranking.seeded_order("key", digits=1)
    want = sorted(ranking.with_rank(df, order, before).collect())
    cut = ranking.with_rank(df, order, before, most=60)
    assert sorted(cut.collect()) == want and [r.rank for r in sorted(want, key=lambda r: r.rank)] == list(range(before or 600))
    keys = [hashlib.md5(f"17:{r.key}".encode()).hexdigest() for r in sorted(want, key=lambda r: r.rank)]
    assert keys == sorted(keys)
    if before is None:
        assert "shiftright" in cut._jdf.queryExecution().analyzed().toString()
        # rows of a positional order with a repeated key, and identical rows
        same = df.select((F.col("key") % 3).alias("key"))
        ranks = ranking.with_rank(same, ranking.positional_order(same, "key"), most=50).collect()
        assert sorted(r.rank for r in ranks) == list(range(600)) and [r.key for r in sorted(ranks, key=lambda r: r.rank)] == sorted(r.key for r in ranks)


def test_one_key_in_all_rows(spark):
    df = spark.range(300).selectExpr("1 as key", "id")
    rows = ranking.corpus_chunks(df, 4, ranking.seeded_order("key")).collect()
    assert Counter(r.chunk for r in rows) == {0: 75, 1: 75, 2: 75, 3: 75} and len({r.id for r in rows}) == 300


def test_copies_of_cuts_stay_below_the_rows(spark):
    df = spark.range(500).selectExpr("id", "concat('s', id % 200) as subset")
    cuts = ranking.cut_keys(df, ranking.seeded_order("id"), lambda total: [F.lit(1)], "subset", bounded=False)
    copies = cuts.select(F.sum(F.expr("bit_count(_salts)")).alias("n"), F.count(F.lit(1)).alias("cuts")).first()
    assert copies.cuts == 200 and copies.n <= 500


@pytest.mark.parametrize("n,fraction", [(100, 0.05), (101, 0.05), (100, 0.07), (140, 0.05), (3, 0.5), (7, 0), (7, 1)])
def test_split_is_exact_disjoint_and_complete(spark, n, fraction):
    rows = ranking.split_exact(numbered(spark, n), fraction, "doc_id").collect()
    test = [r.doc_id for r in rows if r.part == "test"]
    size = math.ceil(round(fraction * n, 9))
    assert sorted(r.doc_id for r in rows) == list(range(n))
    assert set(test) == set(seeded(range(n))[:size])


def test_split_per_subset(spark):
    rows = ranking.split_exact(skewed(spark), 0.1, "doc_id", by="subset").collect()
    assert len(rows) == 2000
    for g in ("hot", "mid", "tiny", None):
        ids = [r.doc_id for r in rows if r.subset == g]
        assert {r.doc_id for r in rows if r.subset == g and r.part == "test"} == set(seeded(ids)[: math.ceil(round(len(ids) * 0.1, 9))])


def test_split_hash_bounds(spark):
    df = numbered(spark, 200)
    assert {r.part for r in ranking.split_hash(df, 1, "doc_id").collect()} == {"test"}
    assert {r.part for r in ranking.split_hash(df, 0, "doc_id").collect()} == {"train"}
    with pytest.raises(ValueError):
        ranking.split_hash(df, 1.5, "doc_id")


def test_composite_key(spark):
    df = numbered(spark, 60).select((F.col("doc_id") % 5).alias("a"), F.floor(F.col("doc_id") / 5).alias("b"))
    rows = ranking.with_rank(df, ranking.seeded_order(["a", "b"])).orderBy("rank").collect()
    keys = sorted(((r.a, r.b) for r in rows), key=lambda k: hashlib.md5(f"17:{k[0]}:{k[1]}".encode()).hexdigest())
    assert [(r.a, r.b) for r in rows] == keys


def test_batches(spark):
    df = numbered(spark, 100)
    placed = batches.assign_batches(df, "doc_id", batch_rows=4, accumulation=3, max_steps=5)
    rows = placed.collect()
    assert len(rows) == 60
    assert all(r.micro_batch == r["rank"] // 4 and r.step == r["rank"] // 12 for r in rows)
    grouped = batches.collect_batches(placed, "doc_id").orderBy("micro_batch").collect()
    assert [x.doc_id for r in grouped for x in r.rows] == seeded(range(100))[:60]


def test_empty_input(spark):
    df = numbered(spark, 0)
    assert ranking.split_exact(df, 0.5, "doc_id").count() == 0
    assert ranking.corpus_chunks(df, 3, ranking.positional_order(df, "doc_id")).count() == 0
    assert ranking.with_rank(df, ranking.seeded_order("doc_id")).count() == 0
