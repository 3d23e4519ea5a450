"""Training rows stored by step."""

import json

import pytest
from pyspark.sql import functions as F

from tests import plain
from tokenloom import plans, sources
from tokenloom.functions.codec import Encoder
from tokenloom.operators.merges import Merge
from tokenloom.operators.permutation import Permutation
from tokenloom.sinks import manifest, steps

MERGES = [Merge(70, 71, 261, 9), Merge(261, 72, 262, 8)]


def ranked(spark, n, parts=3):
    return spark.range(0, n, 1, parts).select(F.expr("(id * 7919 + 13) % " + str(n)).alias("rank"), F.col("id").alias("doc"))


def files_read(frame):
    """Names of the files that a run of the frame opens."""
    return {r.f for r in frame.select(F.input_file_name().alias("f")).distinct().collect()}


def ranks(frame):
    return sorted(r["rank"] for r in frame.collect())


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("steps"))
    # 1009 rows, 12 to a step, 5 steps to a file
    assert steps.write_steps(ranked(spark, 1009), path, 1009, batch_rows=4, accumulation=3, steps_per_file=5) == 85
    return path


def test_rows_of_a_step(spark, stored):
    assert steps.count_steps(spark, stored) == 85
    for first, last in [(0, 1), (7, 8), (3, 17), (84, 85), (84, None), (0, None), (85, None), (9, 9)]:
        frame = steps.read_steps(spark, stored, first, last)
        assert ranks(frame) == list(range(min(first * 12, 1009), min((last or 85) * 12, 1009)))
    rows = steps.read_steps(spark, stored, 20, 21).collect()
    assert all((r.step, r.micro_batch) == (20, r["rank"] // 4) for r in rows)
    assert {r["rank"]: r.doc for r in rows} == {(i * 7919 + 13) % 1009: i for i in range(1009) if 240 <= (i * 7919 + 13) % 1009 < 252}


def test_only_files_of_the_steps_are_opened(spark, stored):
    whole = files_read(steps.read_steps(spark, stored))
    assert len(whole) == 17  # a file holds five steps
    for first, last, files in [(7, 8, 1), (4, 6, 2), (0, 5, 1), (80, None, 1), (40, None, 9)]:
        frame = steps.read_steps(spark, stored, first, last)
        plan = frame._jdf.queryExecution().sparkPlan().toString()
        assert "PartitionFilters: [isnotnull(span" in plan
        frame.collect()
        metrics = frame._jdf.queryExecution().executedPlan().collectLeaves().head().metrics()
        assert metrics.apply("numFiles").value() == files == len(files_read(frame))
    assert all(len(f.split("span=")[1].split("/")) == 2 for f in whole)


@pytest.mark.parametrize("processes", [1, 2, 3])
def test_processes_share_the_micro_batches(spark, stored, processes):
    shares = [steps.read_steps(spark, stored, 2, None, p, processes).collect() for p in range(processes)]
    assert sorted(r["rank"] for s in shares for r in s) == list(range(24, 1009))
    for p, share in enumerate(shares):
        assert {r.micro_batch % 3 % processes for r in share} == {p}
    with pytest.raises(ValueError):
        steps.read_steps(spark, stored, 0, None, processes, processes)


def test_going_on_equals_an_unbroken_run(spark, stored):
    def used(first, last):
        return [(r.step, r["rank"], r.doc) for r in steps.read_steps(spark, stored, first, last).orderBy("rank").collect()]

    assert used(0, 31) + used(31, 60) + used(60, None) == used(0, None)


def test_ranks_must_be_whole(spark, tmp_path):
    missing = ranked(spark, 100).filter("rank <> 57")
    twice = ranked(spark, 100).unionByName(ranked(spark, 100).filter("rank = 8"))
    moved = missing.unionByName(ranked(spark, 100).filter("rank = 8"))
    for frame, total in ((missing, 100), (twice, 100), (moved, 100), (ranked(spark, 100), 101), (ranked(spark, 100), 99)):
        with pytest.raises(ValueError, match="each once"):
            steps.write_steps(frame, f"{tmp_path}/x", total, 2, 2, 4)
    with pytest.raises(ValueError, match="no step table"):
        steps.read_steps(spark, f"{tmp_path}/x")
    assert steps.write_steps(ranked(spark, 100).limit(0), f"{tmp_path}/none", 0, 2, 2, 4) == 0


def test_a_table_is_replaced_as_a_whole(spark, tmp_path):
    path = f"{tmp_path}/t"
    steps.write_steps(ranked(spark, 90), path, 90, 3, 2, 2)
    with pytest.raises(ValueError):
        steps.write_steps(ranked(spark, 50), path, 60, 3, 2, 2)
    assert ranks(steps.read_steps(spark, path)) == list(range(90))
    steps.write_steps(ranked(spark, 40), path, 40, 5, 1, 3)
    assert ranks(steps.read_steps(spark, path)) == list(range(40)) and steps.count_steps(spark, path) == 8
    assert len(manifest.remove_unused(spark, path)) == 2 and ranks(steps.read_steps(spark, path)) == list(range(40))


@pytest.mark.parametrize(("epochs", "max_steps"), [(1, None), (3, None), (2, 5)])
def test_step_job(spark, tmp_path, epochs, max_steps):
    texts = [None if i % 10 == 4 else f"abc cab {i}" for i in range(60)]
    (tmp_path / "in").mkdir()
    for n in range(3):
        lines = [json.dumps({"id": i, "text": t}) + "\n" for i, t in enumerate(texts)][n * 20 : n * 20 + 20]
        (tmp_path / "in" / f"part-{n}.json").write_text("".join(lines))
    rows = sources.read_jsonl(spark, f"{tmp_path}/in", "id long, text string")
    encoder = Encoder(spark, MERGES)
    count = plans.build_step_rows(
        rows, "pretrain", encoder, f"{tmp_path}/out", 16, 5, 4, 2, max_steps, epochs, keep=("id",), steps_per_file=2
    )
    good = [i for i, t in enumerate(texts) if t is not None]
    orders = [Permutation(len(good), 5, epoch=e) for e in range(epochs)]
    want = {e * len(good) + p.rank(at): i for e, p in enumerate(orders) for at, i in enumerate(good)}
    want = {r: i for r, i in want.items() if max_steps is None or r < max_steps * 8}
    got = steps.read_steps(spark, f"{tmp_path}/out/rows").collect()
    assert {r["rank"]: r.id for r in got} == want and len(got) == len(want) and count == -(-len(want) // 8)
    for r in got:
        ids = [0, *[i for w in plain.pretokens(texts[r.id]) for i in plain.encode_word(w, MERGES)], 1]
        assert list(r.input_ids) == (ids + [2] * 16)[:15]
    bad = spark.read.parquet(f"{tmp_path}/out/rejects").collect()
    assert sorted(r.id for r in bad) == [i for i, t in enumerate(texts) if t is None]


def test_tokenizer_corpus_in_file_order(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "part-0.json").write_text("".join(json.dumps({"text": f"t{i}"}) + "\n" for i in range(50)))
    rows = sources.read_jsonl(spark, f"{tmp_path}/in", "text string")
    got = plans.tokenizer_corpus(rows, None, chunks=6).collect()
    assert {r.text: r.chunk for r in got} == {f"t{i}": i // 5 if i < 5 else 1 + (i - 5) // 4 for i in range(25)}


def test_text_moves_to_the_file_of_its_step_and_is_encoded_there(spark, tmp_path, monkeypatch):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "part-0.json").write_text("".join(json.dumps({"id": i, "text": f"abc {i}"}) + "\n" for i in range(40)))
    moved, write = [], steps.write_steps

    def seen(rows, *args):
        moved.extend(f.name for f in rows.schema if f.dataType.typeName() == "array")
        return write(rows, *args)

    monkeypatch.setattr(steps, "write_steps", seen)
    rows = sources.read_jsonl(spark, f"{tmp_path}/in", "id long, text string")
    plans.build_step_rows(rows, "pretrain", Encoder(spark, MERGES), f"{tmp_path}/out", 16, 5, 4, 2, keep=("id",), steps_per_file=2)
    got = steps.read_steps(spark, f"{tmp_path}/out/rows")
    assert not moved and sorted(r.id for r in got.collect()) == list(range(40))
    assert {"id", "rank", "input_ids", "step", "micro_batch"} <= set(got.columns)
