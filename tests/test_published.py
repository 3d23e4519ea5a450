"""Queries at the published vocabulary size, against a plain trainer that goes on until no pair is frequent enough."""

from collections import Counter

import pytest

import __spark_entry__ as contract
from catalog.queries import LEARNED, PUBLISHED, PUBLISHED_QUERIES
from tests import plain
from tests.conftest import SF
from tokenloom.constants import FIRST_MERGE_ID, MIN_FREQUENCY, VOCAB_SIZE


@pytest.fixture(scope="module")
def small(spark, tmp_path_factory):
    """Some documents, the learned merges, and the ids of a text."""
    path = tmp_path_factory.mktemp("published")
    docs = spark.read.parquet(f"{SF}/documents.parquet").filter("n_chars < 600").orderBy("doc_id").limit(25)
    docs.coalesce(1).write.parquet(f"{path}/documents.parquet")
    spark.read.parquet(f"{SF}/benchmark.parquet").limit(10).write.parquet(f"{path}/benchmark.parquet")
    rows = {r.doc_id: r for r in docs.collect()}
    words = Counter(w for r in rows.values() for line in r.text.split("\n") for w in plain.pretokens(line + "\n"))
    learned = plain.train(words, VOCAB_SIZE, MIN_FREQUENCY)
    ids = {d: [i for w in plain.pretokens(r.text) for i in plain.encode_word(w, learned)] for d, r in rows.items()}
    return str(path), rows, learned, ids


def test_sizes_are_the_published_ones():
    assert PUBLISHED.learned == VOCAB_SIZE - FIRST_MERGE_ID == 31739 and PUBLISHED.min_frequency == 5
    assert set(PUBLISHED_QUERIES) <= set(contract.queries())


@pytest.mark.parametrize("name", ["bpe_merges_published", "bpe_merges_small_bounds_published"])
def test_merges_go_to_the_end(spark, small, name):
    path, _, learned, _ = small
    assert len(learned) > 4 * LEARNED
    rows = sorted(contract.queries()[name](spark, path).collect(), key=lambda r: r.rank)
    assert [(r.left, r.right, r.new_id, r["count"]) for r in rows] == learned


def test_encoding_uses_all_merges(spark, small):
    path, rows, learned, ids = small
    # spread_documents may repeat or split rows, so ids are compared for whole documents found there
    got = {r.doc_id: [int(i) for i in r.ids.split(",")] for r in contract.queries()["encode_published"](spark, path).collect()}
    assert got == {d: [0, *i, 1] for d, i in ids.items()}
    assert max(i for row in ids.values() for i in row) > FIRST_MERGE_ID + LEARNED
    text = {r.doc_id: r.plain for r in contract.queries()["decode_published"](spark, path).collect()}
    assert {d: t.lstrip(" ") for d, t in text.items()} == {d: r.text.lstrip(" ") for d, r in rows.items()}
    held = contract.queries()["vocab_published"](spark, path).collect()
    assert len(held) == FIRST_MERGE_ID + len({m[2] for m in learned} - set(range(FIRST_MERGE_ID)))
