"""Round trips in one step: ids that never leave the worker, and the pool of words behind them."""

import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests import plain
from tokenloom.constants import BYTE_IDS, FIRST_MERGE_ID, SPECIAL_TOKENS
from tokenloom.functions import bytelevel, codec, pretokens
from tokenloom.functions.codec import Encoder, decode_ids
from tokenloom.operators import training_rows, vocabulary
from tokenloom.operators.merges import Merge

TEXTS = [
    "", " ", "x", " the theatre", "the\nthe  the ", "nul\0byte", "<s>the</s> a<mask>", "<s>", "你好，世界 + Привет + مرحبًا", "emoji 👩‍👩‍👧 🎉",
    "a\x01 the\x01\x01the", "\x01", "\x01<s>\x01the", " \x01 ", "\xff\xfe the", "the" * 50, "é" * 70 + " the", "123 ½ — it's", None,
]


@pytest.fixture(scope="module")
def made():
    words = {w: 3 for t in TEXTS if t for w in plain.pretokens(t)}
    learned = [Merge(*m) for m in plain.train(words, FIRST_MERGE_ID + 20, 2)]
    return learned, vocabulary.token_texts(learned)


def test_a_round_trip_is_encoding_and_decoding(spark, made):
    learned, tokens = made
    encoder = Encoder(spark, learned)
    df = spark.createDataFrame(list(enumerate(TEXTS)), "i int, t string").repartition(3)
    back, ids = encoder.round_trip(F.col("t"), tokens), encoder.encode(F.col("t"), template=False)
    rows = df.select("i", "t", back.alias("back"), ids.alias("ids")).select("*", decode_ids(F.col("ids"), tokens).alias("text")).collect()
    assert len(rows) == len(TEXTS)
    for r in rows:
        assert (r.back and (r.back.n, bytes(r.back.bytes).decode())) == (r.ids if r.ids is None else (len(r.ids), r.text))


def test_decoding_is_done_and_compared(spark, made):
    learned, tokens = made
    df = spark.createDataFrame([("a", t) for t in TEXTS], "lang string, text string")
    encoder = Encoder(spark, learned)
    wrong = [*tokens[:-1], tokens[-1] + "x"]
    ids, found = encoder.encode(F.col("text"), template=False), []
    for table in (tokens, wrong):
        same = decode_ids(ids, table) == pretokens.with_prefix_space(F.col("text"))
        # a null text counts as a mismatch
        found.append(df.filter(~F.coalesce(same, F.lit(False))).count())
        row = training_rows.round_trip(df, encoder, table, "lang").first()
        assert (row.rows, row.mismatches) == (len(TEXTS), found[-1])
    assert 0 < found[0] < found[1] < len(TEXTS)
    with pytest.raises(Exception, match="out of bounds"):
        training_rows.round_trip(df, encoder, tokens[:40], "lang").collect()


def test_ids_do_not_reach_the_plan(spark, made):
    learned, tokens = made
    df = spark.createDataFrame([("a", "the")], "lang string, text string")
    plan = training_rows.round_trip(df, Encoder(spark, learned), tokens, "lang")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1 and "element_at" not in plan


def test_only_words_with_a_merge_are_merged(monkeypatch, made):
    learned, _ = made
    rng = random.Random(3)
    words = sorted({"".join(rng.choice("theqqqé你") for _ in range(rng.randrange(1, 9))) for _ in range(300)} | {"q", "你"})
    coder, sizes = codec._WordCodec(BYTE_IDS, [m[:3] for m in learned], {}), []
    merge = codec.merge_flat
    monkeypatch.setattr(codec, "merge_flat", lambda ids, starts, *tables: sizes.append(len(starts) - 1) or merge(ids, starts, *tables))
    pairs = {m[:2] for m in learned}
    want = sum(any(p in pairs for p in zip(i, i[1:])) for i in ([BYTE_IDS[b] for b in w.encode()] for w in words))
    assert coder.encode(pa.array([words])).to_pylist()[0] == [i for w in words for i in plain.encode_word(w, learned)]
    assert sizes == [want] and 0 < want < len(words)


def test_the_pool_holds_what_the_cache_holds(monkeypatch, made):
    learned, _ = made
    monkeypatch.setattr(codec, "CACHED_WORDS", 30)
    monkeypatch.setattr(codec, "SLICE_WORDS", 7)
    monkeypatch.setattr(codec, "BATCH_WORDS", 3)
    monkeypatch.setattr(codec, "SPARE_IDS", 64)
    coder = codec._WordCodec(BYTE_IDS, [m[:3] for m in learned], {t: i for i, t in enumerate(SPECIAL_TOKENS)})
    rng, largest = random.Random(4), 0
    for _ in range(60):
        drawn = [rng.choice(["the", "q", "<s>", "he" * 40, "你好", "é"]) + rng.choice(["", "t", "h" * rng.randrange(80)]) for _ in range(20)]
        lists = [drawn[:9], None, [], drawn[9:]]
        want = [w if w is None else [i for x in w for i in ([0] if x == "<s>" else plain.encode_word(x, learned))] for w in lists]
        assert coder.encode(pa.array(lists, pa.list_(pa.string()))).to_pylist() == want
        assert coder.cache.keys().isdisjoint(w for w in drawn if len(w) > 64) and len(coder.cache) <= 30
        largest = max(largest, len(coder.pool))
    coder.cache.clear()
    coder.encode(pa.array([["a"]]))
    assert len(coder.pool) <= 64 < largest


def test_words_with_end_marks_are_the_same_words(spark):
    rng = random.Random(8)
    drawn = ["".join(rng.choice("the  \n\t'sA1²é你\u3000\u0085\x01<s>-") for _ in range(rng.randrange(25))) for _ in range(300)]
    df = spark.createDataFrame(list(enumerate(TEXTS + drawn)), "i int, t string")
    rows = df.select(pretokens.encode_words(F.col("t")).alias("words"), pretokens.ended_words(F.col("t")).alias("ended")).collect()
    assert sum(r.ended is not None and bytes(r.ended[:1]) == b"\xff" for r in rows) > 20
    ended = pa.array([None if r.ended is None else bytes(r.ended) for r in rows], pa.binary())
    assert codec.split_words(ended).to_pylist() == [r.words for r in rows]
    assert codec.split_words(ended.slice(7, 90)).to_pylist() == [r.words for r in rows[7:97]]
    for none in (ended.slice(0, 0), pa.array([None, b""], pa.binary())):
        assert codec.split_words(none).to_pylist() == [None, []][: len(none)]


@pytest.mark.parametrize("size", [1, 40, 8_000_000])
def test_texts_go_back_some_at_a_time(monkeypatch, made, size):
    learned, tokens = made
    monkeypatch.setattr(codec, "SLICE_BYTES", size)
    monkeypatch.setattr(codec, "SLICE_WORDS", 5)
    coder = codec._WordCodec(BYTE_IDS, [m[:3] for m in learned], {"<s>": 0})
    by_id = pa.array([bytelevel.byte_text(t).encode("latin-1") for t in tokens], pa.large_binary())
    texts = [[" the", " q"] * 4, None, [], [" x\x01", "<s>"], ["\u4f60"] * 9, [" the"]]
    ended = [w and (b"\xff" + b"\xff".join(x.encode() for x in w) + b"\xff" if "<s>" in w else b"".join(x.encode() + b"\x01" for x in w)) for w in texts]
    parts = list(coder.round_trip(pa.array([w if w != [] else b"" for w in ended], pa.binary()), by_id))
    assert len(parts) > 1
    want = [w if w is None else {"n": sum(1 if x == "<s>" else len(plain.encode_word(x, learned)) for x in w), "bytes": "".join(w).encode()} for w in texts]
    assert [r for p in parts for r in p.to_pylist()] == want
