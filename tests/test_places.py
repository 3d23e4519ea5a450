"""Order by place in the files, and the permutation that needs no sort."""

import json
from decimal import Decimal

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from tests.conftest import SF
from tokenloom import sources
from tokenloom.operators import batches, places
from tokenloom.operators.permutation import Permutation


@pytest.fixture(scope="module")
def files(spark, tmp_path_factory):
    """JSON lines of unequal length in several files, read in many splits; blank lines and an empty file are no rows."""
    folder = tmp_path_factory.mktemp("lines")
    rows, at = [], 0
    for n, count in enumerate([0, 7, 1, 260, 90, 3]):
        text = ""
        for i in range(count):
            rows.append((at, f"t{at % 5}" + "x" * (at * 37 % 400)))
            text += json.dumps({"id": at, "text": rows[-1][1]}) + "\n" + ("\n" if i % 11 == 3 else "")
            at += 1
        (folder / f"part-{n:05d}.json").write_text(text)
    keep = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
    spark.conf.set("spark.sql.files.openCostInBytes", "100")
    yield str(folder), rows
    for k, v in keep.items():
        spark.conf.set(k, v)


def read(spark, files):
    return sources.read_jsonl(spark, files[0], "id long, text string")


def test_positions_are_the_order_of_the_files(spark, files):
    df = read(spark, files)
    assert df.rdd.getNumPartitions() > 5
    got = places.with_position(df).collect()
    assert sorted((r.position, r.id, r.text) for r in got) == [(i, *row) for i, row in enumerate(files[1])]
    some = places.with_position(df.filter("id % 3 = 1").withColumn("more", F.lit(1)), "at").collect()
    assert sorted((r["at"], r.id) for r in some) == list(enumerate(range(1, len(files[1]), 3)))


@pytest.mark.parametrize("percent", [0, 0.3, 12.5, 50, 99.9, 100])
def test_head(spark, files, percent):
    n = round(Decimal(str(percent)) / 100 * len(files[1]))
    got = [r.id for r in places.head_by_place(read(spark, files), percent).collect()]
    assert sorted(got) == list(range(n))


@pytest.mark.parametrize(("chunks", "percent"), [(1, 100), (6, 100), (6, 50), (7, 1), (40, 100)])
def test_chunks(spark, files, chunks, percent):
    n = round(len(files[1]) * percent / 100)
    size, rest = divmod(n, chunks)
    want = {i: (i // (size + 1) if i < rest * (size + 1) else rest + (i - rest * (size + 1)) // size) for i in range(n)}
    df = read(spark, files)
    assert {r.id: r.chunk for r in places.chunks_by_place(df, chunks, percent=percent).collect()} == want
    both = sorted((r.chunk, r.id) for r in places.chunks_by_place(df, chunks, compat=True, percent=percent).collect())
    assert both == [(c, i) for c in range(chunks) for i in range(size + (c < rest))]


def test_nothing_moves(spark, files):
    """The payload is read once and crosses no exchange; what is exchanged has a row per split."""
    for frame in (places.chunks_by_place(read(spark, files), 6), places.with_position(read(spark, files))):
        plan = frame._jdf.queryExecution().optimizedPlan().toString()
        assert "Sort" not in plan
        physical = frame._jdf.queryExecution().sparkPlan().toString()
        assert sum("ReadSchema: struct<id:bigint,text:string>" in line for line in physical.splitlines()) == 1
        for line in physical.splitlines():
            assert "Exchange" not in line or "text" not in line


@pytest.mark.parametrize("kind", ["parquet", "text"])
def test_other_formats(spark, tmp_path, kind):
    rows = [(f"line {i}",) for i in range(500)]
    spark.createDataFrame(rows, "value string").coalesce(1).write.format(kind).save(f"{tmp_path}/t")
    df = spark.read.schema("value string").format(kind).load(f"{tmp_path}/t")
    assert sorted((r.position, r.value) for r in places.with_position(df).collect()) == [(i, v) for i, (v,) in enumerate(rows)]
    assert places.head_by_place(df.filter("value = 'x'"), 50).collect() == []


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 3000), st.integers(0, 10**9), st.integers(2, 8))
def test_permutation_is_one(n, seed, rounds):
    p = Permutation(n, seed, rounds)
    ranks = [p.rank(i) for i in range(n)]
    assert sorted(ranks) == list(range(n)) and all(p.position(r) == i for i, r in enumerate(ranks))


def test_permutation_looks_random():
    p = Permutation(10_000, 3)
    ranks = [p.rank(i) for i in range(10_000)]
    assert sum(r == i for i, r in enumerate(ranks)) < 10
    assert sum(abs(a - b) == 1 for a, b in zip(ranks, ranks[1:])) < 20
    # a block of neighbours falls evenly over the whole
    tenths = [0] * 10
    for r in ranks[:2000]:
        tenths[r // 1000] += 1
    assert 140 < min(tenths) and max(tenths) < 260
    assert Permutation(10_000, 4).rank(77) != p.rank(77)


@pytest.mark.parametrize("n", [1, 2, 3, 10, 97, 1000, 10007])
def test_expression_equals_the_loop(spark, n):
    p = Permutation(n, 5)
    rows = spark.range(n).select("id", p.rank_column(F.col("id")).alias("rank"))
    rows = rows.withColumn("back", p.position_column(F.col("rank"))).collect()
    assert [(r.rank, r.back) for r in sorted(rows)] == [(p.rank(i), i) for i in range(n)]


def test_expression_of_large_positions(spark):
    p = Permutation(3 * 10**9 + 7, 1)
    at = [0, 1, 2, 10**9, 3 * 10**9 + 6]
    rows = spark.createDataFrame([(i,) for i in at], "i long").select("i", p.rank_column(F.col("i")).alias("r")).collect()
    assert {r.i: r.r for r in rows} == {i: p.rank(i) for i in at}


def test_batches_without_a_sort(spark, files):
    df = read(spark, files)
    n = len(files[1])
    frame = batches.assign_batches_by_place(df, seed=4, batch_rows=8, accumulation=3)
    p = Permutation(n, 4)
    assert sorted((r.rank, r.id, r.micro_batch, r.step) for r in frame.collect()) == sorted(
        (p.rank(i), i, p.rank(i) // 8, p.rank(i) // 24) for i in range(n)
    )
    plan = frame._jdf.queryExecution().optimizedPlan().toString()
    assert "Sort" not in plan and "Repartition" not in plan
    few = batches.assign_batches_by_place(df, seed=4, batch_rows=8, accumulation=3, max_steps=2).collect()
    assert sorted(r.rank for r in few) == list(range(48))
    twice = batches.assign_batches_by_place(df, seed=4, batch_rows=8, accumulation=3, epochs=2).collect()
    second = Permutation(n, 4, epoch=1)
    assert sorted((r.rank, r.id) for r in twice) == sorted([(p.rank(i), i) for i in range(n)] + [(n + second.rank(i), i) for i in range(n)])
