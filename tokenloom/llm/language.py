"""Language identification: script ranges narrow the candidates, Viterbi over word scores labels spans of mixed text.

A word is a run of letters and marks. Its score for a language is the log probability of its character n-grams (one to
four, lower case, with a space on both sides) in hashed tables learned from labelled texts. The script of its first
letter leaves only languages that were seen in that script, if there are any. Over the words of a text, Viterbi finds the
best path of languages, where each change costs ``SWITCH``. The prediction is the language of most letters, its score
their share.

Fitting uses a bounded sample: the ``PER_LANGUAGE`` rows of each language that come first by a hash of the id. Counting the n-grams
is a Spark aggregation; the model has ``2 ** BITS`` numbers per language. Prediction is a narrow step over whole texts.

Defined results: ``und`` with score 0 for a null text, a text without letters, or a model without languages; ties go to the language that
sorts first; null labels are not learned from; an empty table gives an empty result; other columns may have any name.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tokenloom.llm.minhash import mixed, text_slices
from tokenloom.session import ship_package

PER_LANGUAGE = 1000
BITS = 16
ORDERS = 4
SWITCH = 12.0
SLICE = 2 << 20
UNKNOWN = "und"
# First and last code point of the letters of a script.
SCRIPTS = {
    "latin": [(0x41, 0x24F), (0x1E00, 0x1EFF)], "greek": [(0x370, 0x3FF), (0x1F00, 0x1FFF)], "cyrillic": [(0x400, 0x52F)],
    "armenian": [(0x530, 0x58F)], "hebrew": [(0x590, 0x5FF)], "arabic": [(0x600, 0x77F), (0x8A0, 0x8FF)], "devanagari": [(0x900, 0x97F)],
    "bengali": [(0x980, 0x9FF)], "tamil": [(0xB80, 0xBFF)], "thai": [(0xE00, 0xE7F)], "georgian": [(0x10A0, 0x10FF)],
    "hangul": [(0x1100, 0x11FF), (0xAC00, 0xD7AF)], "kana": [(0x3040, 0x30FF)], "han": [(0x3400, 0x4DBF), (0x4E00, 0x9FFF)],
}
OTHER = len(SCRIPTS) + 1
_KNOWN = 0x32000


@dataclass
class LanguageModel:
    """Languages in order, ``scores[bucket, language]`` and ``allowed[script, language]``."""

    languages: list[str] = field(default_factory=list)
    scores: np.ndarray | None = None
    allowed: np.ndarray | None = None


@lru_cache(maxsize=1)
def character_tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each code point: script of a letter (0 for none), whether a mark, and its lower case."""
    script, mark, lower = np.zeros(_KNOWN, dtype="uint8"), np.zeros(_KNOWN, dtype=bool), np.arange(_KNOWN, dtype="uint32")
    for point in range(_KNOWN):
        kind = unicodedata.category(chr(point))
        if kind[0] == "L":
            script[point] = OTHER
            low = chr(point).lower()
            lower[point] = ord(low) if len(low) == 1 else point
        mark[point] = kind[0] == "M"
    for number, ranges in enumerate(SCRIPTS.values(), 1):
        for first, last in ranges:
            inside = script[first : last + 1]
            inside[inside > 0] = number
    return script, mark, lower


@dataclass
class Words:
    """Words of some texts, text by text: number of the text, first and last character in the text, letters, and script."""

    owner: np.ndarray
    begin: np.ndarray
    end: np.ndarray
    script: np.ndarray
    start: np.ndarray
    stop: np.ndarray
    points: np.ndarray


def words_of(texts: list[str]) -> Words:
    script_of, mark_of, lower_of = character_tables()
    points = np.frombuffer((" " + " ".join(texts) + " ").encode("utf-32-le", "replace"), dtype="<u4")
    known = np.minimum(points, _KNOWN - 1)
    script = script_of[known]
    inside = script > 0
    marks = mark_of[known]
    if marks.any():
        # a mark belongs to the word that it follows
        last = np.maximum.accumulate(np.where(~marks, np.arange(len(points)), 0))
        inside = inside | (marks & inside[last])
    edge = np.diff(inside.astype("int8"))
    start, stop = np.flatnonzero(edge == 1) + 1, np.flatnonzero(edge == -1) + 1
    sizes = np.array([len(t) for t in texts], dtype="int64")
    first = np.cumsum(sizes + 1) - sizes
    owner = np.searchsorted(first, start, side="right") - 1
    lowered = np.where(inside, lower_of[known], 32).astype("uint64")
    return Words(owner, start - first[owner], stop - first[owner], script[start], start, stop, lowered)


def ngrams(words: Words) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each order: bucket of the n-gram that ends at a position, and whether it lies in a word with its two spaces."""
    points = words.points
    reach = np.zeros(len(points), dtype="int64")  # characters since the space before the word, that space included
    if len(words.start):
        span = words.stop - words.start
        at = np.repeat(words.start, span + 1) + (np.arange(int((span + 1).sum())) - np.repeat(np.cumsum(span + 1) - span - 1, span + 1))
        reach[at] = at - np.repeat(words.start, span + 1) + 2
    with np.errstate(over="ignore"):
        for order in range(1, ORDERS + 1):
            value = np.full(len(points), order, dtype="uint64")
            for back in range(order - 1, -1, -1):
                shifted = np.r_[np.full(back, 32, dtype="uint64"), points][: len(points)]
                value = value * np.uint64(0x100000001B3) + shifted
            valid = reach > order - 1 if order > 1 else (reach > 0) & (points != 32)
            yield (mixed(value) >> np.uint64(64 - BITS)).astype("int64"), valid


def word_scores(model: LanguageModel, words: Words) -> np.ndarray:
    """``[word, language]``: log probabilities; languages that the script rules out are far below."""
    if not len(words.start):
        return np.zeros((0, len(model.languages)), dtype="float32")
    total = np.zeros((len(words.points), len(model.languages)), dtype="float32")
    for bucket, valid in ngrams(words):
        at = np.flatnonzero(valid)
        total[at] += model.scores[bucket[at]]
    # a word's positions run to the space after it
    bounds = np.stack([words.start, words.stop + 1], axis=1).ravel()
    summed = np.add.reduceat(np.vstack([total, np.zeros((1, total.shape[1]), dtype="float32")]), np.minimum(bounds, len(total)))[::2]
    return np.where(model.allowed[words.script], summed / ORDERS, summed / ORDERS - 1000).astype("float32")


def best_path(scores: np.ndarray, counts: np.ndarray, switch: float) -> np.ndarray:
    """Language of every word. All texts advance by one word at a time; ``counts`` are their numbers of words."""
    order = np.argsort(-counts, kind="stable")
    first, left = (np.cumsum(counts) - counts)[order], counts[order]
    steps = int(left[0]) if len(left) else 0
    active = np.searchsorted(-left, -np.arange(steps), side="left")
    back = np.empty(scores.shape, dtype="int16")
    own = np.arange(scores.shape[1], dtype="int16")
    state = np.zeros((len(counts), scores.shape[1]))
    for t in range(steps):
        k = active[t]
        at, now = first[:k] + t, state[:k]
        top = now.argmax(axis=1)
        changed = now[np.arange(k), top][:, None] - switch
        stays = now >= changed
        back[at] = np.where(stays, own, top[:, None])
        state[:k] = np.where(stays, now, changed) + scores[at]
    path = np.empty(len(scores), dtype="int16")
    label = state.argmax(axis=1)
    for t in range(steps - 1, -1, -1):
        k = active[t]
        at = first[:k] + t
        path[at] = label[:k]
        label[:k] = back[at, label[:k]]
    return path


def identify(model: LanguageModel, batch: pa.Array, switch: float = SWITCH) -> pa.Array:
    """Struct ``lang, score, spans`` of every text; spans are character ranges from their first word to their last."""
    n, size = len(batch), len(model.languages)
    parts, base = [], 0
    if size:
        for piece in text_slices(batch, SLICE):
            words = words_of([value or "" for value in piece.to_pylist()])
            parts.append((words.owner + base, words.begin, words.end, word_scores(model, words)))
            base += len(piece)
    if parts:
        owner, begin, end, scores = (np.concatenate(column) for column in zip(*parts))
    else:
        owner = begin = end = np.zeros(0, dtype="int64")
        scores = np.zeros((0, max(size, 1)), dtype="float32")
    counts = np.bincount(owner, minlength=n)
    path = best_path(scores, counts, switch)
    letters = np.bincount(owner * max(size, 1) + path, weights=end - begin, minlength=n * max(size, 1)).reshape(n, -1)
    total, best = letters.sum(axis=1), letters.argmax(axis=1) if n else np.zeros(0, dtype="int64")
    lang = [model.languages[b] if t else UNKNOWN for b, t in zip(best, total)]
    score = np.divide(letters.max(axis=1) if n else total, total, out=np.zeros(n), where=total > 0)
    new = np.r_[True, (owner[1:] != owner[:-1]) | (path[1:] != path[:-1])] if len(owner) else np.zeros(0, dtype=bool)
    at = np.flatnonzero(new)
    last = np.r_[at[1:], len(owner)] - 1 if len(at) else at
    names = pa.DictionaryArray.from_arrays(pa.array(path[at], pa.int16()), pa.array(model.languages, pa.string())).cast(pa.string())
    spans = pa.StructArray.from_arrays([pa.array(begin[at], pa.int64()), pa.array(end[last], pa.int64()), names], ["begin", "end", "lang"])
    offsets = np.r_[0, np.cumsum(np.bincount(owner[at], minlength=n))]
    rows = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), spans)
    return pa.StructArray.from_arrays([pa.array(lang, pa.string()), pa.array(score, pa.float64()), rows], ["lang", "score", "spans"])


def fit_languages(docs: DataFrame, id: str = "doc_id", text: str = "text", lang: str = "lang", per_language: int = PER_LANGUAGE) -> LanguageModel:
    """Learn from the rows with a language, ``per_language`` of each at most."""
    ship_package(docs.sparkSession)
    labelled = docs.select(F.col(f"`{id}`").alias("id"), F.col(f"`{lang}`").alias("lang"), F.col(f"`{text}`").alias("text"))
    labelled = labelled.filter(F.col("lang").isNotNull() & F.col("text").isNotNull())
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.xxhash64("id"), "id"))
    # each task passes on per_language rows of a language at most; so many ids are broadcast
    chosen = labelled.select("id", "lang").withColumn("place", place).filter(F.col("place") <= per_language)
    chosen = chosen.select(F.col("id").alias("of"), F.col("lang").alias("named"))
    sample = labelled.join(F.broadcast(chosen), F.col("id").eqNullSafe(F.col("of")) & (F.col("lang") == F.col("named")))

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for code in np.unique(np.array(batch["lang"].to_pylist(), dtype=object)):
                texts = [t for t, l in zip(batch["text"].to_pylist(), batch["lang"].to_pylist()) if l == code]
                words = words_of(texts)
                total = np.zeros(1 << BITS, dtype="int64")
                for bucket, valid in ngrams(words):
                    total += np.bincount(bucket[valid], minlength=1 << BITS)
                scripts = np.bincount(words.script, weights=words.stop - words.start, minlength=OTHER + 1).astype("int64")
                every = np.r_[total, scripts]
                at = np.flatnonzero(every)
                yield pa.RecordBatch.from_arrays([pa.array([code] * len(at), pa.string()), pa.array(at, pa.int32()), pa.array(every[at], pa.int64())], ["lang", "at", "n"])

    tallies = sample.select("lang", "text").mapInArrow(counted, "lang string, at int, n long")
    found = tallies.groupBy("lang", "at").agg(F.sum("n").alias("n")).toPandas()  # bounded by the model's size
    languages = sorted(found["lang"].unique())
    if not languages:
        return LanguageModel()
    counts = np.zeros(((1 << BITS) + OTHER + 1, len(languages)))
    for number, code in enumerate(languages):
        part = found[found["lang"] == code]
        counts[part["at"].to_numpy(), number] = part["n"].to_numpy()
    grams, scripts = counts[: 1 << BITS] + 0.1, counts[1 << BITS :]
    allowed = scripts >= 0.001 * np.maximum(scripts.sum(axis=0), 1)
    allowed[~allowed.any(axis=1)] = True
    return LanguageModel(languages, np.log(grams / grams.sum(axis=0)).astype("float32"), allowed)


def identify_documents(docs: DataFrame, model: LanguageModel, text: str = "text", out: str = "language", switch: float = SWITCH) -> DataFrame:
    """All columns and a struct: ``lang``, ``score`` (0 to 1) and ``spans`` (begin, end, lang)."""
    spark: SparkSession = docs.sparkSession
    ship_package(spark)
    shared = spark.sparkContext.broadcast(model)

    @F.arrow_udf("lang string, score double, spans array<struct<begin: bigint, end: bigint, lang: string>>")
    def identified(texts: pa.Array) -> pa.Array:
        return identify(shared.value, texts, switch)

    return docs.withColumn(out, identified(F.col(f"`{text}`")))
