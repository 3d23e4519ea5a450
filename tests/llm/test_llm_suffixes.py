import hashlib
import random

import pytest
from llm_plain import awkward

from tokenloom.llm import suffixes


def removed(texts, length):
    """Covered bytes of every text, by counting all strings."""
    data = [(t or "").encode() for t in texts]
    seen = {}
    for d in data:
        for p in range(len(d) - length + 1):
            seen[d[p : p + length]] = seen.get(d[p : p + length], 0) + 1
    out = []
    for d in data:
        cover = bytearray(len(d))
        for p in range(len(d) - length + 1):
            if seen[d[p : p + length]] > 1:
                cover[p : p + length] = b"\1" * length
        out.append(cover)
    return data, out


def spans(cover):
    edges = [i for i in range(len(cover) + 1) if (i and cover[i - 1]) != (i < len(cover) and cover[i])]
    return [(b, e) for b, e in zip(edges[::2], edges[1::2])]


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(9)
    noise = lambda n: "".join(rng.choice("abcdefgh éü中\n") for _ in range(n))
    passage, short, line = noise(330), noise(60), noise(90)
    out = [None, "", "x", noise(500), noise(199)]
    for n in range(14):
        cut = rng.randrange(0, 120)
        out.append(noise(rng.randrange(0, 300)) + passage[cut : cut + rng.randrange(190, 330)] + noise(rng.randrange(0, 200)))
    out += [noise(100) + short + noise(200) for _ in range(5)]
    out += [line * 9, noise(30) + line * 4, "ab" * 400, "z" * 900, "\0" * 250, "\0" * 230 + "q"]
    out += [out[6], out[6], passage, passage]
    return out


@pytest.mark.parametrize(("length", "gram", "large"), [(200, 50, 256), (200, 50, 2), (60, 16, 256), (60, 16, 3)])
def test_equals_brute_force(spark, texts, monkeypatch, length, gram, large):
    monkeypatch.setattr(suffixes, "LARGE", large)
    monkeypatch.setattr(suffixes, "RANGE_ROWS", 60)
    rows = {r.id: r for r in suffixes.remove_repeats(awkward(spark, texts), length=length, gram=gram).collect()}
    for i, (data, cover) in enumerate(zip(*removed(texts, length))):
        kept = bytes(b for b, c in zip(data, cover) if not c)
        assert [(s.begin, s.end) for s in rows[i].spans] == spans(cover), i
        assert rows[i].kept_sha256 == hashlib.sha256(kept).hexdigest() and rows[i].n_bytes == len(data)
        assert (kept == data) if rows[i].kept is None else bytes(rows[i].kept) == kept


def test_loser_tree_merges_runs_without_comparing_known_bytes():
    rng = random.Random(10)
    runs = [sorted(bytes(rng.choice(b"ab") for _ in range(rng.randrange(1, 40))) for _ in range(rng.randrange(0, 30))) for _ in range(7)]
    coded = [[row for row in suffixes.front_coded([(b"", 0, s, b"") for s in run])] for run in runs]
    last, out = b"", []
    for known, suffix, _ in suffixes.LoserTree(coded):
        assert known == suffixes._common_prefix(last, suffix, 0)
        out.append(suffix)
        last = suffix
    assert out == sorted(s for run in runs for s in run)
    assert list(suffixes.LoserTree([])) == []


def test_null_and_repeated_ids_and_empty_table(spark):
    text = "".join(random.Random(11).choice("abcdef") for _ in range(400))
    rows = suffixes.remove_repeats(awkward(spark, [text, text, "k" + text], ids=[None, 3, 3])).collect()
    assert sorted([(s.begin, s.end) for s in r.spans] for r in rows) == [[(0, 400)], [(0, 400)], [(1, 401)]]
    assert suffixes.remove_repeats(awkward(spark, ["a"]).limit(0)).count() == 0
    with pytest.raises(ValueError):
        suffixes.remove_repeats(awkward(spark, ["a"]), length=20, gram=30)
