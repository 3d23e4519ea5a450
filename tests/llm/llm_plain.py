"""Plain versions and awkward inputs for the tests of the operators."""

import re

AWKWARD = "doc_id long, text string, lang string, source string, n_chars long, hash string, key string, row string, salt int, id string"


def awkward(spark, texts, sources=None, ids=None):
    """Documents with columns whose names clash with inner ones."""
    ids = ids or list(range(len(texts)))
    rows = [(i, t, "en", (sources or ["a"] * len(texts))[n], len(t or ""), "h", "k", "r", 1, "x") for n, (i, t) in enumerate(zip(ids, texts))]
    return spark.createDataFrame(rows, AWKWARD)


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def shingles(text, size=5):
    w = words(text)
    return {tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))} if w else set()


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0
