"""Hot groups: one conversation, language or text holds a large part of all rows."""

import pytest
from pyspark.sql import functions as F

from catalog import queries
from catalog.inputs import instruct_source
from tests import plain
from tokenloom.operators import wordstats


@pytest.fixture(scope="module")
def hot_dir(spark, tmp_path_factory):
    """Conversation 7 holds most turns, over several blocks; one text is most documents."""
    path = tmp_path_factory.mktemp("hot")
    turns = [(7, 0, "system", "be brief")]
    turns += [(7, t, "user" if t % 2 else "assistant", f"hot {t}") for t in range(1, 901)]
    for c in range(20, 60):
        turns += [(c, 0, "system", f"s{c}")] if c % 3 == 0 else []
        turns += [(c, t, "user" if t % 2 else "assistant", f"c{c} {t}") for t in range(1, 8)]
    schema = "conv_id long, turn long, role string, text string"
    spark.createDataFrame(turns, schema).repartition(5).write.parquet(f"{path}/conversations.parquet")
    docs = [(i, "same text here" if i % 3 else f"text {i}", "en" if i % 3 else "fr", "src", 14) for i in range(600)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(docs, schema).repartition(5).write.parquet(f"{path}/documents.parquet")
    return str(path), turns, docs


def test_instruct_rows_of_a_hot_conversation(spark, hot_dir):
    path, turns, _ = hot_dir
    by_place = {(c, t): (role, text) for c, t, role, text in turns}
    expected = {
        (c, t): (by_place.get((c, 0), (None, None))[1], text, by_place[c, t + 1][1])
        for (c, t), (role, text) in by_place.items()
        if role == "user" and by_place.get((c, t + 1), ("",))[0] == "assistant"
    }
    rows = instruct_source(spark, path).collect()
    assert len(rows) == len(expected)
    assert {(r.conv_id, r.turn): (r.instruct, r.input, r.output) for r in rows} == expected


def test_rendering_of_a_hot_conversation(spark, hot_dir):
    path, turns, _ = hot_dir
    rows = sorted(queries.chat_render(spark, path).collect())
    assert [r.segment for r in rows if r.conv_id == 7] == [0, 1, 2, 3]
    for conv in {t[0] for t in turns}:
        messages = [{"role": t[2], "content": t[3]} for t in sorted(turns) if t[0] == conv]
        assert "".join(r.text for r in rows if r.conv_id == conv) == plain.render(messages)


def test_counts_of_a_hot_text(spark, hot_dir):
    path, _, docs = hot_dir
    expected = {}
    for _, text, *_ in docs:
        for word in plain.pretokens(text + "\n"):
            expected[word] = expected.get(word, 0) + 1
    counted = queries.word_counts(spark, path)
    assert {r.word: r.n for r in counted.collect()} == expected
    # combined before the exchange
    plan = wordstats.word_counts(wordstats.corpus_lines(spark.read.parquet(f"{path}/documents.parquet")))
    assert "partial_count" in plan._jdf.queryExecution().executedPlan().toString()


def test_samples_with_a_hot_language(spark, hot_dir):
    path, _, docs = hot_dir
    rows = queries.split_per_subset(spark, path).groupBy("lang", "part").count().collect()
    assert {(r.lang, r.part): r["count"] for r in rows} == {
        ("en", "test"): 40, ("en", "train"): 360, ("fr", "test"): 20, ("fr", "train"): 180
    }
    assert queries.collect_batches(spark, path).agg(F.count("*")).first()[0] == 19
