"""Merges recovered from a vocabulary, and training that goes on from it."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tests import plain
from tokenloom.constants import BYTE_IDS, FIRST_MERGE_ID, SPECIAL_TOKENS, STAND_INS
from tokenloom.operators import recovery, vocabulary, wordstats
from tokenloom.operators.merges import learn_merges

FULL = dict(enumerate(SPECIAL_TOKENS)) | dict(zip(BYTE_IDS, STAND_INS))


def table(spark, tokens):
    return vocabulary.vocab_from_map(spark.createDataFrame([(t, i) for i, t in tokens.items()], "token string, id int"))


def recovered(spark, tokens):
    return {r.id: None if r.left is None else (r.left, r.right) for r in recovery.recover_merges(table(spark, tokens)).collect()}


@pytest.fixture(scope="module")
def words(docs):
    counts = Counter()
    for r in docs.select("text").collect():
        counts.update(w for line in r.text.split("\n") for w in plain.pretokens(line + "\n"))
    # the plain trainer counts all words again for each merge
    return Counter(dict(counts.most_common(2500)))


def symbols(spark, words):
    return wordstats.symbol_words(spark.createDataFrame(list(words.items()), "word string, n long"))


def test_parts_equal_the_plain_recovery():
    rng = random.Random(6)
    for _ in range(300):
        tokens = {"".join(rng.choice("abc") for _ in range(rng.randrange(2, 9))) for _ in range(30)}
        ids = {t: i for i, t in enumerate(rng.sample(sorted(tokens), len(tokens)))}
        for t in ids:
            assert recovery.final_parts(t, ids) == plain.recover(t, ids)
    assert recovery.final_parts("a" * 4096, {"a" * 2**n: n for n in range(1, 13)}) == ["a" * 2048] * 2


def test_a_trained_vocabulary_gives_its_merges_back(spark, words):
    learned = learn_merges(symbols(spark, words), FIRST_MERGE_ID + 600, 2)
    tokens = dict(enumerate(vocabulary.token_texts(learned)))
    assert recovered(spark, tokens) == {m.new_id: (m.left, m.right) for m in learned}


def test_every_token_with_a_merge_is_produced(spark, words):
    """Also where the bytes have other ids, ids have gaps, and some tokens cannot be made."""
    rng = random.Random(1)
    learned = learn_merges(symbols(spark, words), FIRST_MERGE_ID + 200, 2)
    texts = vocabulary.token_texts(learned)
    merged = [t for t in texts[FIRST_MERGE_ID:] if rng.random() < 0.8]
    shuffled = rng.sample(STAND_INS, 256)
    tokens = {2 * i + 7: t for i, t in enumerate([*shuffled, *merged, "Ġqqqzz", *SPECIAL_TOKENS])}
    ids = {t: i for i, t in tokens.items()}
    got = recovered(spark, tokens)
    assert set(got) == {ids[t] for t in [*merged, "Ġqqqzz"]} and got[ids["Ġqqqzz"]] is None
    ranks = {t: ids[t] for t in [*merged, "Ġqqqzz"]}
    for t in ranks:
        parts = plain.recover(t, ranks)
        assert got[ids[t]] == (tuple(ids[p] for p in parts) if len(parts) == 2 else None)
    base = recovery.base_of(table(spark, tokens))
    assert [m.new_id for m in base.merges] == sorted(i for i, pair in got.items() if pair)
    found = {tokens[m.new_id]: m.new_id for m in base.merges}
    assert len(found) > 60
    stand_in = {c: b for b, c in enumerate(STAND_INS)}
    rows = [(t, i) for t, i in found.items() if _is_word(t, stand_in)]
    frame = spark.createDataFrame([(_text(t, stand_in), i) for t, i in rows], "t string, i int")
    encoded = frame.select("t", "i", base.encoder(spark).encode(F.col("t"), template=False).alias("ids")).collect()
    assert len(encoded) > 40 and all(r.ids == [r.i] for r in encoded)


def _text(token, stand_in):
    return bytes(stand_in[c] for c in token).decode()


def _is_word(token, stand_in):
    """Whether a text of this token alone is one word, so that no leading space is added."""
    try:
        text = _text(token, stand_in)
    except UnicodeDecodeError:
        return False
    return text.startswith(" ") and plain.pretokens(text) == [text]


@pytest.mark.parametrize("bounds", [(), (8, 300, 2000)])
def test_training_goes_on_from_a_base(spark, words, bounds):
    rng = random.Random(3)
    first = learn_merges(symbols(spark, {w: n for w, n in words.items() if len(w) % 3 or len(w) < 5}), FIRST_MERGE_ID + 60, 2)
    texts = vocabulary.token_texts(first)
    # other ids, a token that only a learned pair can spell, and room between ids
    order = [*rng.sample([*SPECIAL_TOKENS, *STAND_INS], 261), *texts[FIRST_MERGE_ID:]]
    tokens = {3 * i: t for i, t in enumerate(order)} | {2000: "Ġwhiches"}
    known = table(spark, tokens)
    base = recovery.base_of(known)
    assert base.byte_ids == [next(i for i, t in tokens.items() if t == c) for c in STAND_INS]
    rounds = []
    learned = learn_merges(symbols(spark, words), 2001 + 150, 2, *bounds, rounds=rounds, base=base)
    assert learned == plain.train(words, 2001 + 150, 2, tokens, base.merges)
    assert min(m.new_id for m in learned) >= 2000 and len(learned) >= 150 and (not bounds or len(rounds) > 2)
    joint = {r.id: r.token for r in recovery.joint_vocab(known, base, learned).collect()}
    assert {i: joint[i] for i in tokens} == tokens and set(joint) == set(tokens) | set(range(2001, 2151))
    merged, texts = [*base.merges, *learned], ["the which of these", "zebra <s> und", "éa 中", ""]
    frame = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    got = {r.i: r.ids for r in frame.select("i", base.encoder(spark, learned).encode(F.col("t"), template=False).alias("ids")).collect()}
    for i in (0, 2, 3):
        assert got[i] == [x for w in plain.pretokens(texts[i]) for x in plain.encode_word(w, merged, base.byte_ids)]
    assert [i for i, t in tokens.items() if t == "<s>"][0] in got[1]


def test_what_a_vocabulary_lacks_is_added(spark):
    known = recovery.complete(table(spark, {5: "Ġhello", 9: "Ġhe", 7: "Ġh"}))
    base = recovery.base_of(known)
    # Ġhello has a lower id than its parts, so nothing makes it
    assert [(base.texts[m.left], base.texts[m.right], m.new_id) for m in base.merges] == [("Ġ", "h", 7), ("Ġh", "e", 9)]
    assert set(base.texts) == {5, 7, 9, *range(10, 271)}
    with pytest.raises(ValueError, match="unique"):
        recovery.base_of(known.unionByName(known.limit(1)))
