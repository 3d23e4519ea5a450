"""Steps replayed as a stream."""

import pytest

from tokenloom.operators.permutation import Permutation
from tokenloom.sinks import steps
from tokenloom.streaming import replay


@pytest.fixture(scope="module")
def table(spark, tmp_path_factory):
    """Two epochs of 50 rows, 8 to a step."""
    path = str(tmp_path_factory.mktemp("replay"))
    rows = [(e * 50 + Permutation(50, 3, epoch=e).rank(i), i) for e in range(2) for i in range(50)]
    assert steps.write_steps(spark.createDataFrame(rows, "rank long, doc long"), path, 100, 4, 2, 3) == 13
    return path


def test_two_epochs_in_order(spark, table, tmp_path):
    seen = []
    replay.replay_steps(spark, table, f"{tmp_path}/c", lambda rows, n: seen.append((n, sorted((r["rank"], r.doc) for r in rows.collect()))), steps_per_batch=2)
    assert [n for n, _ in seen] == list(range(7))
    flat = [pair for _, rows in seen for pair in rows]
    assert [rank for rank, _ in flat] == list(range(100))
    first, second = [d for r, d in flat if r < 50], [d for r, d in flat if r >= 50]
    assert sorted(first) == sorted(second) == list(range(50)) and first != second


@pytest.mark.parametrize("lost", [0, 2, 4])
def test_a_restart_uses_no_step_twice(spark, table, tmp_path, lost):
    used, calls = [], []

    def use(rows, number):
        calls.append(number)
        if len(calls) == lost + 1:
            raise RuntimeError("lost")
        used.append((number, sorted({r.step for r in rows.collect()})))

    args = (spark, table, f"{tmp_path}/c", use)
    with pytest.raises(Exception, match="lost"):
        replay.replay_steps(*args, steps_per_batch=3)
    assert len(used) == lost
    replay.replay_steps(*args, steps_per_batch=3)
    replay.replay_steps(*args, steps_per_batch=3)  # nothing is left
    assert [s for _, part in used for s in part] == list(range(13)) and [n for n, _ in used] == list(range(5))


def test_a_part_for_one_process(spark, table, tmp_path):
    replay.store_steps(spark, table, f"{tmp_path}/o", f"{tmp_path}/c", first=2, last=9, steps_per_batch=4, process=1, processes=2)
    rows = spark.read.parquet(f"{tmp_path}/o").collect()
    assert sorted(r["rank"] for r in rows) == [r for r in range(16, 72) if r // 4 % 2 == 1]
    assert all(r.batch == (r.step - 2) // 4 for r in rows)


def test_stored_micro_batches_share_triggers(spark, table, tmp_path):
    query = replay.store_steps(spark, table, f"{tmp_path}/o", f"{tmp_path}/c", last=9, steps_per_batch=2)
    assert query.lastProgress["batchId"] == 0  # five micro batches, one trigger
    replay.store_steps(spark, table, f"{tmp_path}/o", f"{tmp_path}/c", steps_per_batch=2, batches_per_trigger=1)
    rows = spark.read.parquet(f"{tmp_path}/o").collect()
    assert sorted(r["rank"] for r in rows) == list(range(100))
    # the first call stopped within a micro batch, the second one went on with a new number
    assert all(r.batch == (r.step // 2 if r.step < 9 else 5 + (r.step - 9) // 2) for r in rows)


def test_a_trigger_that_is_lost_is_written_again(spark, table, tmp_path, monkeypatch):
    read, calls = replay.read_steps, []

    def failing(*args):
        calls.append(args)
        if len(calls) == 2:
            raise RuntimeError("lost")
        return read(*args)

    monkeypatch.setattr(replay, "read_steps", failing)
    args = (spark, table, f"{tmp_path}/o", f"{tmp_path}/c")
    with pytest.raises(Exception, match="lost"):
        replay.store_steps(*args, steps_per_batch=3, batches_per_trigger=2)
    replay.store_steps(*args, steps_per_batch=3, batches_per_trigger=2)
    rows = spark.read.parquet(f"{tmp_path}/o").collect()
    assert sorted(r["rank"] for r in rows) == list(range(100)) and all(r.batch == r.step // 3 for r in rows)


def test_a_process_without_micro_batches(spark, table, tmp_path):
    replay.store_steps(spark, table, f"{tmp_path}/o", f"{tmp_path}/c", process=2, processes=3)
    assert spark.read.parquet(f"{tmp_path}/o").count() == 0


def test_a_few_steps_list_their_folders_alone(spark, table):
    few = steps.read_steps(spark, table, 3, 5)
    index = few._jdf.queryExecution().analyzed().collectLeaves().head().relation().location()
    assert [p.toString().rsplit("/", 1)[1] for p in (index.rootPaths().apply(i) for i in range(index.rootPaths().size()))] == ["span=1"]
