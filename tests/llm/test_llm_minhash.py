import random

import numpy as np
import pyarrow as pa
import pytest
from llm_plain import awkward, jaccard, shingles

from tokenloom.llm import minhash


def classes_of(texts, threshold=0.8):
    """Connected classes by comparing all pairs."""
    sets, parent = [shingles(t) for t in texts], list(range(len(texts)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            same = (texts[i] or "") == (texts[j] or "")
            if same or (sets[i] and sets[j] and jaccard(sets[i], sets[j]) >= threshold):
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    return [root(i) for i in range(len(texts))]


def edited(rng, words, n):
    out = list(words)
    for _ in range(n):
        out[rng.randrange(len(out))] = f"e{rng.random()}"
    return out


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(6)
    out = [None, "", " ", "a b", "a b", "b a"]
    for family in range(12):
        base = [f"w{rng.randrange(3000)}" for _ in range(rng.randrange(30, 300))]
        out += [" ".join(edited(rng, base, n)) for n in (0, 0, 1, 2, 4, 9)]
    # a chain: each is near the one before only
    chain = [f"c{i}" for i in range(400)]
    out += [" ".join(chain[20 * i : 20 * i + 240]) for i in range(8)]
    # one large group of near copies, some of them far from each other
    base = [f"g{i}" for i in range(200)]
    out += [" ".join(edited(rng, base, rng.randrange(1, 6))) for _ in range(120)]
    return out


def test_classes_equal_brute_force(spark, texts):
    rows = {r.id: r for r in minhash.near_classes(awkward(spark, texts)).collect()}
    want = classes_of(texts)
    assert [rows[i].class_id for i in range(len(texts))] == want
    assert all(rows[i].class_size == want.count(want[i]) for i in range(len(texts)))
    assert sorted(i for i, r in rows.items() if r.kept) == sorted(set(want))


def test_rows_that_stay(spark, texts):
    docs = awkward(spark, texts)
    kept = minhash.near_dedup(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(classes_of(texts)))


def test_signatures_estimate_probability_jaccard():
    rng = np.random.default_rng(7)
    shared, m = rng.integers(1, 2**63, 300, dtype="uint64"), 4096
    one, two = np.r_[shared, rng.integers(1, 2**63, 100, dtype="uint64")], np.r_[shared, rng.integers(1, 2**63, 60, dtype="uint64")]
    w1, w2 = rng.integers(1, 6, 400).astype(float), rng.integers(1, 6, 360).astype(float)
    w2[:300] = w1[:300]
    got = minhash.prob_minhash(np.r_[np.zeros(400, int), np.ones(360, int)], np.r_[one, two], np.r_[w1, w2], 2, m)
    x, y = np.r_[w1, np.zeros(60)], np.r_[w1[:300], np.zeros(100), w2[300:]]
    want = sum(1 / np.maximum(x / x[i], y / y[i]).sum() for i in range(300))
    assert (got[0] == got[1]).mean() == pytest.approx(want, abs=0.04)


def test_shingle_counts():
    owner, element, times = minhash.shingles(pa.array(["a b c d e f a b c d e f", "x", None, "p q r s t"]))
    assert np.bincount(owner, minlength=4).tolist() == [6, 1, 0, 1]
    assert sorted(times[owner == 0].tolist()) == [1, 1, 1, 1, 2, 2]


def test_components(spark):
    links = [(f"n{i:03}", f"n{i + 1:03}") for i in range(60)] + [("z1", "z2"), ("hub", "x1"), ("hub", "x2"), ("x2", "x1")]
    got = {r.node: r["class"] for r in minhash.components(spark.createDataFrame(links, "a string, b string")).collect()}
    assert {got[f"n{i:03}"] for i in range(61)} == {"n000"} and got["z2"] == "z1" and got["x2"] == got["x1"] == "hub"


def test_null_and_repeated_ids_and_empty_table(spark):
    text = " ".join(f"w{i}" for i in range(50))
    docs = awkward(spark, [text, text, text + " more", "other", "other"], ids=[None, 5, 5, None, None])
    rows = minhash.near_classes(docs).collect()
    assert sorted((r.class_id or -1, r.class_size) for r in rows) == [(-1, 2), (-1, 2), (5, 3), (5, 3), (5, 3)]
    assert sorted(r.text[:5] for r in minhash.near_dedup(docs).collect()) == ["other", "w0 w1"]
    assert minhash.near_classes(docs.limit(0)).count() == 0 and minhash.near_dedup(docs.limit(0)).count() == 0


def test_leaders_grow_until_no_member_is_left(spark):
    # one band of one register: buckets full of texts that are not alike
    rng = random.Random(8)
    common = [f"c{i}" for i in range(60)]
    texts = [" ".join(common + [f"u{k}x{rng.random()}" for _ in range(12 + k % 5)]) for k in range(40)]
    rows = {r.id: r.class_id for r in minhash.near_classes(awkward(spark, texts), bands=8, rows=1).collect()}
    assert [rows[i] for i in range(40)] == classes_of(texts)


def test_repeated_lines_do_not_part_near_copies(spark):
    rng, texts = random.Random(9), []
    for family in range(6):
        lines = [" ".join(f"f{family}w{rng.randrange(3000)}" for _ in range(10)) for _ in range(20)]
        texts += ["\n".join(lines + [lines[-1]] * (times - 1)) for times in (1, 40, 1000)]
    # most occurrences are of one line, but the sets are not alike
    texts += [f"{texts[0]}\n" + "\n".join([f"x{k}{j} y z" for j in range(100)] + ["one line of six words here"] * 1000) for k in range(4)]
    want = classes_of(texts)
    assert want[:18] == [i // 3 * 3 for i in range(18)] and want[18:] == [18, 19, 20, 21]
    rows = {r.id: r.class_id for r in minhash.near_classes(awkward(spark, texts)).collect()}
    assert [rows[i] for i in range(len(texts))] == want


def test_comparisons_grow_with_a_group_and_not_with_its_square(spark, monkeypatch):
    compared, verified = [], minhash.verified

    def counted(pairs, sets):
        compared[-1] += pairs.distinct().count()
        return verified(pairs, sets)

    monkeypatch.setattr(minhash, "verified", counted)
    rng = random.Random(11)
    base = [f"b{i}" for i in range(200)]
    group = [" ".join(edited(rng, base, rng.randrange(1, 9))) for _ in range(240)]
    for n in (60, 240):
        compared.append(0)
        rows = {r.id: r.class_id for r in minhash.near_classes(awkward(spark, group[:n])).collect()}
        assert [rows[i] for i in range(n)] == classes_of(group[:n])
    assert compared[1] <= 6 * compared[0]


def test_rounds_exchange_little_more_than_their_rows(spark, monkeypatch):
    """Classes are joined from links between classes, so a round has few exchanges, and a chain takes few rounds whatever its names."""
    written, write = [], minhash.materialise
    monkeypatch.setattr(minhash, "materialise", lambda df, name: written.append(name) or write(df, name))
    links = [(f"n{i:03}", f"n{i + 1:03}") for i in range(60)]
    got = {r.node: r["class"] for r in minhash.contracted(spark.createDataFrame(links, "a string, b string")).collect()}
    assert len(got) == 61 and len(set(got.values())) == 1 and written.count("steps") <= 12
    written.clear()
    rng = random.Random(12)
    base = [f"b{i}" for i in range(200)]
    group = [" ".join(edited(rng, base, rng.randrange(1, 9))) for _ in range(60)]
    rows = {r.id: r.class_id for r in minhash.near_classes(awkward(spark, group)).collect()}
    assert [rows[i] for i in range(60)] == classes_of(group)
    assert len(written) <= 50
