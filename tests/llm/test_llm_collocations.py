import random
import re
from collections import Counter

import numpy as np
import pytest
from llm_plain import AWKWARD

from tokenloom.llm import collocations
from tokenloom.llm.words import byte_set, split_words

import pyarrow as pa

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, least=10, top=2000, percent=50):
    counts, sizes = {}, Counter()
    for lang, text in rows:
        lang = lang if lang is not None else "und"
        count = counts.setdefault(lang, Counter())
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(LOWER)):
            words = re.findall("[^\x20\x09]+", piece)
            sizes[lang] += len(words)
            for k in (1, 2, 3):
                count.update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, count in counts.items():
        kept, longest = [], {}
        for p, f in count.items():
            if len(p) == 3 and f >= least:
                for part in (p[:2], p[1:]):
                    longest[part] = max(longest.get(part, 0), f)
        for phrase, a in count.items():
            if len(phrase) < 2 or a < least or (phrase in longest and 100 * longest[phrase] >= percent * a):
                continue
            cuts = [(1000000 * a * a // (count[phrase[:k]] * count[phrase[k:]]), k) for k in range(1, len(phrase))]
            score, k = min(cuts)
            kept.append((-score, -a, " ".join(phrase).encode(), count[phrase[:k]], count[phrase[k:]]))
        out += [(lang, n + 1, p.decode(), -a, l, r, sizes[lang], -s) for n, (s, a, p, l, r) in enumerate(sorted(kept)[:top])]
    return sorted(out)


def found(spark, rows, **more):
    frame = spark.createDataFrame([(i, t, lang, "a", 0, "h", "k", "r", 1, "x") for i, (lang, t) in enumerate(rows)], AWKWARD)
    return sorted(map(tuple, collocations.collocations(frame, **more).collect()))


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(2)
    words = ["New", "york", "ÉTÉ", "été", "中文", "a", "b", "the", "The", "of", "x-y", "rare"]
    join = [" ", " ", " ", "\t", "  ", ", ", ".", "\n", "!?", "\r\n"]
    out = [(None, None), ("en", None), ("en", ""), (None, "  .. \t"), ("fr", "one two"), ("", "a b " * 12)]
    for n in range(160):
        text = "".join(rng.choice(words) + rng.choice(join) for _ in range(rng.randrange(0, 60)))
        out.append((rng.choice(["en", "en", "en", "de", None]), text))
    out += [("en", "new york city hall " * 40), ("en", "the the the the " * 30), ("de", "w" * 5000 + " " + "z" * 3000), ("de", "u v " * 9)]
    out += [("en", " ".join(f"w{n} w{n + 1}" for n in range(3000)))] * 12  # many phrases with equal scores
    return out


def test_equals_brute_force(spark, rows):
    assert found(spark, rows) == brute(rows)


def test_parameters(spark, rows):
    assert found(spark, rows, least=2, top=15, inside_percent=80) == brute(rows, 2, 15, 80)


def test_without_phrases(spark):
    assert found(spark, []) == [] and found(spark, [("en", "one two three"), (None, None)]) == []


def test_one_pair_everywhere(spark):
    """A pair that holds most places, with endless continuations: its suffixes go to many tasks, its count stays whole."""
    rows = [("en", " ".join(f"big pair t{n % 701} u{n % 13}" for n in range(a, a + 2000))) for a in range(0, 40_000, 2000)]
    assert found(spark, rows) == brute(rows)


def test_quicksort_counts():
    rng = np.random.default_rng(1)
    n = 3 * collocations.SMALL
    for spread in (3, 40, 3000):
        keys = [rng.integers(-1, spread, n).astype(np.int32) for _ in range(3)]
        for j in (1, 2):
            keys[j][keys[j - 1] < 0] = -1
        weight = rng.integers(1, 4, n)
        want = {}
        for d in range(3):
            for row in range(n):
                head = tuple(int(k[row]) for k in keys[: d + 1])
                if min(head) >= 0:
                    want[head] = want.get(head, 0) + int(weight[row])
        want = {p: c for p, c in want.items() if c >= 20}
        got = {tuple(int(k[row]) for k in keys[: d + 1]): c for d, row, c in collocations.quicksort_counts(keys, weight, 20)}
        assert got == want


def test_words_of_many_texts():
    texts = pa.array(["ab  Cd.e", None, "", "f", " .", "É中 x", "g"])
    owner, piece, words = split_words(texts.slice(0), byte_set(b" "), byte_set(b"."))
    assert [w.decode() for w in words.to_pylist()] == ["ab", "cd", "e", "f", "É中", "x", "g"]
    assert owner.tolist() == [0, 0, 0, 3, 5, 5, 6] and piece[0] == piece[1] != piece[2] and len(set(piece.tolist())) == 5
    assert split_words(texts.slice(3, 1), byte_set(b" "))[2].to_pylist() == [b"f"] and len(split_words(texts.slice(1, 2), byte_set(b" "))[2]) == 0
