"""What a batch, a task and the driver hold does not grow with the table."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from catalog import queries
from tests import plain
from tests.conftest import SF
from tokenloom.constants import BYTE_IDS, FIRST_MERGE_ID, STAND_INS
from tokenloom.functions import bytelevel, codec
from tokenloom.operators import columns, merges


def test_only_the_best_pairs_reach_the_driver(spark, monkeypatch):
    letters = "".join(map(bytelevel.symbol, range(10, 20)))
    words = spark.range(3000).select(F.translate(F.col("id").cast("string"), "0123456789", letters).alias("s"), F.col("id").alias("n"))
    plans, collect = [], type(words).collect
    monkeypatch.setattr(type(words), "collect", lambda self: plans.append(self._jdf.queryExecution().sparkPlan().toString()) or collect(self))
    top = merges._top_pairs(words, 7)
    # a top-k at the root of a plan sends the k best rows of every task
    assert len(plans) == 1 and not plans[0].startswith("TakeOrdered") and "TakeOrdered" in plans[0]
    whole = sorted(merges.count_pairs(words).toLocalIterator(), key=lambda r: (-r.n, r.pair))
    assert top == whole[:7]


@pytest.mark.parametrize("size", [1, 3, 7, 1000])
def test_ids_are_made_in_slices(monkeypatch, size):
    coder = codec._WordCodec(BYTE_IDS, [(70, 71, 261)], {"<s>": 0})
    lists = [["ab", "abc"], [], None, ["<s>"], ["x" * 9, "ab", "\u00e9", "ab"], None, ["q"]]
    words = pa.array([["cut"], *lists], pa.list_(pa.string())).slice(1)
    made, counts = coder._assembled, []
    monkeypatch.setattr(coder, "_assembled", lambda part: counts.append((len(part), len(part.flatten()))) or made(part))
    monkeypatch.setattr(codec, "SLICE_WORDS", size)
    want = [w and [i for x in w for i in np.frombuffer(coder.word(x), np.int32).tolist()] if w is not None else None for w in lists]
    assert coder.encode(words).to_pylist() == want
    assert sum(n for n, _ in counts) == len(lists) and all(n <= size or rows == 1 for rows, n in counts)
    assert coder.encode(words.slice(0, 0)).to_pylist() == []


def test_new_words_are_merged_side_by_side(monkeypatch):
    rng = random.Random(11)
    words = sorted({"".join(rng.choice("aaeinrst \u00e9") for _ in range(rng.randrange(1, 40))) for _ in range(400)})
    learned = plain.train({w: 1 + i % 3 for i, w in enumerate(words)}, FIRST_MERGE_ID + 60, 2)
    words += ["a" * n for n in (41, 62, 64)] + ["\u00e9" * 64, "<s>"]
    # a pair that is named twice counts as its last place
    table = [tuple(m[:3]) for m in learned[:40]] + [tuple(m[:3]) for m in learned[20:]]
    coder = codec._WordCodec(BYTE_IDS, table, {"<s>": 0})
    want, alone = [codec._WordCodec(BYTE_IDS, table, {"<s>": 0}).word(w) for w in [*words, "a" * 65]], []
    one = codec.merge_word
    monkeypatch.setattr(codec, "merge_word", lambda ids, merges: alone.append(len(ids)) or one(ids, merges))
    made = coder._assembled(pa.array([[*words, "a" * 65]])).to_pylist()[0]
    assert made == [i for p in want for i in np.frombuffer(p, np.int32).tolist()]
    assert alone == [65] and set(coder.cache) == set(words)


def test_a_product_that_is_an_older_token_is_merged_in_turn():
    a, b, c, d, e = (BYTE_IDS[ord(x)] for x in "abcde")
    # cd spells the token that ab makes, and that token merges with c before c and d do
    table = [(a, b, 300), (300, c, 301), (c, d, 300), (300, e, 302)]
    coder = codec._WordCodec(BYTE_IDS, table, {})
    assert coder.tables is None
    made = coder._assembled(pa.array([["cdcd", "cde", "abab"]])).to_pylist()[0]
    assert made == [301, d, 302, 300, 300]


def test_a_task_remembers_a_bounded_number_of_words(monkeypatch):
    monkeypatch.setattr(codec, "CACHED_WORDS", 5)
    coder = codec._WordCodec(BYTE_IDS, [], {})
    for words in (["a", "b", "c"], ["d", "e", "f"], list("ghijklm"), ["a", "d"]):
        assert coder._assembled(pa.array([words])).to_pylist()[0] == [BYTE_IDS[ord(w)] for w in words]
        assert len(coder.cache) <= 5


def test_a_function_gets_a_bounded_batch(spark):
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "10000")
    try:
        made = columns.map_batches(spark.range(0, 2500, 1, 1), lambda b: {"n": [len(b)] * len(b), "at": list(b.index)}, "n long, at long").collect()
    finally:
        spark.conf.set(setting, before)
    assert [(r.id, r["at"]) for r in made] == [(i, i % columns.FUNCTION_ROWS) for i in range(2500)]
    assert {r.n for r in made} == {1000, 500}


def test_texts_of_bytes_are_decoded_per_token(spark):
    tokens = ["<s>", *STAND_INS, STAND_INS[0] + STAND_INS[10], STAND_INS[0xC3] + STAND_INS[0xA9]]
    assert bytelevel.byte_text("".join(STAND_INS)) == "".join(map(chr, range(256)))
    ids = [0, 258, 257, 11, 1, 66]
    row = spark.createDataFrame([(ids,), ([],), (None,)], "ids array<int>").select(codec.decode_ids(F.col("ids"), tokens).alias("t"))
    assert [r.t for r in row.collect()] == ["<s>\u00e9\0\n\n\0A", "", None]


def test_line_files_follow_the_splits(spark):
    setting = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "10000")
    try:
        lines = queries._lines_backwards(spark, SF)
        assert len(lines.inputFiles()) > queries.CHUNKS
    finally:
        spark.conf.set(setting, before)
    assert lines.count() == queries.documents(spark, SF).count()
