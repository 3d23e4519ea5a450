"""Words counted by array kernels."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from tests import plain
from tokenloom.operators import wordstats

LINES = ["the theatre\n", "the <s> the\n", "a\x01the\x01 the\n", "\x01", "", None, "nul\0 it's 123 ½　\u0085 é你\n", "\n", "x" * 400 + " the\n"]


@pytest.mark.parametrize("size", [1, 60, 16_000_000])
def test_words_are_counted_where_they_are_split(spark, monkeypatch, size):
    monkeypatch.setattr(wordstats, "COUNTED_BYTES", size)
    lines = spark.createDataFrame([(line,) for line in LINES * 30], "line string").repartition(3)
    want = Counter(w for line in LINES * 30 if line for w in plain.pretokens(line))
    counted = wordstats.word_counts(lines, batched=True)
    assert {r.word: r.n for r in counted.collect()} == want == {r.word: r.n for r in wordstats.word_counts(lines).collect()}
    assert counted.schema.simpleString() == "struct<word:string,n:bigint>"


def test_no_row_per_word(spark):
    lines = spark.range(0, 500, 1, 2).select(F.lit("the cat and the dog\n").alias("line"))
    counted = wordstats.word_counts(lines, batched=True)
    assert {r.word: r.n for r in counted.collect()} == {" the": 1000, " cat": 500, " and": 500, " dog": 500, "\n": 500}
    plan = counted._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan and plan.index("Exchange") < plan.index("partial_sum")


def test_no_words(spark):
    for rows in ([], [("",)], [(None,)]):
        assert not wordstats.word_counts(spark.createDataFrame(rows, "line string"), batched=True).collect()
