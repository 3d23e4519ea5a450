"""Toxicity by compression distance: windows are compressed with a dictionary of toxic and one of ordinary text.

A window is one word between spaces, three times over (so that a known word costs one reference and an unknown one pays for its letters
once); a word of more than ``LONG`` bytes is cut into overlapping windows. Its two compressed lengths, with its own length, make a
cell, and the thresholds are calibrated per cell: the log ratio of how often toxic and ordinary documents have such
windows. The highest ratio and the sum of the high ones are a document's evidence; a logistic function turns it into a score.

Fitting uses a bounded sample of labelled rows, about ``TOXIC_ROWS`` with label 1 and ``ORDINARY_ROWS`` with label 0, picked by
a hash of the id. One half gives the dictionaries: the toxic one is trained on the words that toxic documents have more
often than chance allows (likelihood ratio test), the ordinary one on the most frequent ordinary words. The other half gives thresholds
and the logistic function, with rows weighted back to the labels' true shares. Scoring is a narrow step over whole texts;
what a worker remembers about words is bounded.

Defined results: a null text counts as empty and an empty text has no evidence, its score is that of no evidence; null labels
are not learned from; without rows of both labels every score is the share of label 1 (0 without labels); an empty
table gives an empty result; other columns may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tokenloom.llm.common import materialise, text_or_empty
from tokenloom.llm.minhash import text_slices
from tokenloom.session import ship_package

TOXIC_ROWS, ORDINARY_ROWS = 4000, 12000
TOXIC_BYTES, ORDINARY_BYTES = 16384, 112640
WORDS = 100_000
LEAST_EVIDENCE = 12.0
LONG = 48
CELL_PRIOR = 1.0
REPEAT = 3
REMEMBERED = 200_000
SLICE = 2 << 20
_PARAMETERS = dict(
    window_log=20, chain_log=18, hash_log=18, search_log=8, min_match=4, target_length=64, strategy=zstandard.STRATEGY_BTULTRA,
    format=zstandard.FORMAT_ZSTD1_MAGICLESS, write_content_size=False, write_checksum=False, write_dict_id=False,
)


@dataclass
class ToxicityModel:
    """Two dictionaries, the log ratio of each cell, and the logistic weights; bounded by their sizes above."""

    toxic: bytes = b""
    ordinary: bytes = b""
    ratios: dict[int, float] = field(default_factory=dict)
    weights: tuple[float, ...] = (0.0, 0.0, 0.0, 0.0)
    share: float = 0.0

    @cached_property
    def key(self) -> tuple:
        return self.toxic, self.ordinary, hash(frozenset(self.ratios.items()))


def trained_dictionary(words: list[tuple[str, int]], size: int) -> bytes:
    """A trained dictionary; the words themselves where there are too few of them to train one."""
    samples = [f" {word} ".encode() for word, n in words for _ in range(min(n, 50))]
    try:
        return zstandard.train_dictionary(size, samples, level=19).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[:size] or b" "


@lru_cache(maxsize=4)
def _compressor(dictionary: bytes) -> zstandard.ZstdCompressor:
    return zstandard.ZstdCompressor(
        dict_data=zstandard.ZstdCompressionDict(dictionary), compression_params=zstandard.ZstdCompressionParameters(**_PARAMETERS)
    )


def _lengths(dictionary: bytes, windows: list[bytes]) -> np.ndarray:
    """Compressed lengths, some thousand windows at a time."""
    found = []
    for start in range(0, len(windows), 8192):
        packed = _compressor(dictionary).multi_compress_to_buffer(windows[start : start + 8192], threads=1)
        found += [len(frame) for frame in packed]
    return np.array(found, dtype="int64")


def window_cells(model: ToxicityModel, windows: list[bytes]) -> np.ndarray:
    """Cell of each window: its length and both compressed lengths, as one number."""
    if not windows:
        return np.zeros(0, dtype="int64")
    repeated = [b" " + b" ".join([w] * REPEAT) + b" " for w in windows]
    size = np.minimum([len(w) for w in windows], 31)
    toxic, ordinary = _lengths(model.toxic, repeated), _lengths(model.ordinary, repeated)
    return (size * 256 + np.minimum(toxic, 255)) * 256 + np.minimum(ordinary, 255)


def word_windows(word: str) -> list[bytes]:
    data = word.encode("utf-8", "replace")
    if len(data) <= LONG:
        return [data]
    return [data[at : at + LONG] for at in range(0, len(data) - LONG // 2, LONG // 2)]


def split_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """Words of a batch: number of the text, number of the distinct word, and the distinct words."""
    lists = pc.utf8_split_whitespace(pc.fill_null(texts.cast(pa.large_string()), ""))
    owner = np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy(zero_copy_only=False))
    coded = lists.flatten().dictionary_encode()
    codes, words = coded.indices.to_numpy(zero_copy_only=False), coded.dictionary.to_pylist()
    visible = np.array([bool(w) for w in words], dtype=bool)[codes] if len(codes) else np.zeros(0, dtype=bool)
    return owner[visible], codes[visible], words


_remembered: dict[tuple, dict[str, tuple[float, float]]] = {}


def word_evidence(model: ToxicityModel, words: list[str]) -> np.ndarray:
    """Highest log ratio of each word's windows."""
    if model.key not in _remembered:
        _remembered.clear()
    known = _remembered.setdefault(model.key, {})
    if len(known) > REMEMBERED:
        known.clear()
    new = [w for w in words if w not in known]
    cut = [word_windows(w) for w in new]
    cells = window_cells(model, [w for part in cut for w in part])
    ratios = np.array([model.ratios.get(int(c), 0.0) for c in cells])
    ends = np.cumsum([0, *map(len, cut)])
    if new:
        best = np.maximum.reduceat(ratios, ends[:-1])
        known.update(zip(new, best.tolist()))
    return np.array([known[w] for w in words])


def document_evidence(model: ToxicityModel, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Highest log ratio, sum of the ratios over 1, and the word with the highest (its number, -1 for none)."""
    owner, codes, words = split_words(texts)
    ratio = word_evidence(model, words)[codes] if len(codes) else np.zeros(0)
    high, total, worst = np.zeros(len(texts)), np.zeros(len(texts)), np.full(len(texts), -1)
    if len(owner):
        starts = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
        best = np.maximum.reduceat(ratio, starts)
        high[owner[starts]] = np.maximum(best, 0)
        total[owner[starts]] = np.add.reduceat(np.where(ratio > 1, ratio, 0), starts)
        order = np.lexsort((-ratio, owner))
        worst[owner[starts]] = codes[order][starts]
    return high, total, np.array([words[i] if i >= 0 else "" for i in worst], dtype=object)


def features(high: np.ndarray, total: np.ndarray) -> np.ndarray:
    return np.stack([np.ones_like(high), high, np.log1p(np.maximum(total - high, 0)), np.maximum(high - 4, 0)], axis=1)


def fit_logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 0.3) -> np.ndarray:
    """Weighted logistic regression by Newton steps; a few rows leave the slopes small, so that scores stay near the share."""
    w, penalty = np.zeros(x.shape[1]), np.full(x.shape[1], ridge)
    penalty[0] = 1e-3
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (weight * (y - p)) - penalty * w
        hessian = (x * (weight * p * (1 - p))[:, None]).T @ x + np.diag(penalty)
        step = np.linalg.solve(hessian, gradient)
        w = w + step
        if np.abs(step).max() < 1e-8:
            break
    return w


def _sample(labelled: DataFrame, id: str, text: str, label: str, rows: dict[int, int], seed: int) -> tuple[DataFrame, dict[int, int]]:
    """About so many rows of each label, by a hash of the id; and the rows that there are."""
    counts = {r[label]: r["count"] for r in labelled.filter(F.col(label).isin(0, 1)).groupBy(label).count().collect()}
    place = F.pmod(F.xxhash64(F.lit(seed), F.col(id)), F.lit(1 << 30)) / float(1 << 30)
    keep = F.lit(False)
    for value, most in rows.items():
        keep = keep | ((F.col(label) == value) & (place < most / max(counts.get(value, 0), 1)))
    half = F.pmod(F.xxhash64(F.lit(seed + 1), F.col(id)), F.lit(2)).cast("int")
    kept = labelled.filter(keep).select(F.col(id).alias("id"), F.col(label).alias("label"), half.alias("half"))
    return kept, counts


def fit_toxicity(
    docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", label: str = "toxic",
    toxic_rows: int = TOXIC_ROWS, ordinary_rows: int = ORDINARY_ROWS, seed: int = 17,
) -> ToxicityModel:
    """Learn from the documents that ``labels`` names. The picked ids are broadcast, ``toxic_rows + ordinary_rows`` at most, about."""
    spark = docs.sparkSession
    ship_package(spark)
    picked, counts = _sample(labels, id, text, label, {1: toxic_rows, 0: ordinary_rows}, seed)
    share = counts.get(1, 0) / max(sum(counts.values()), 1)
    if not counts.get(0) or not counts.get(1):
        return ToxicityModel(share=share)
    whole = docs.select(F.col(f"`{id}`").alias("at"), text_or_empty(text).alias("text"))
    rows = materialise(whole.join(F.broadcast(picked), F.col("at") == F.col("id")).select("id", "label", "half", "text"), "labelled")
    words = rows.filter("half = 0").select("label", F.explode(F.array_distinct(F.split("text", r"\s+"))).alias("word"))
    counted = words.filter(F.length("word").between(1, LONG)).groupBy("word").agg(
        F.sum("label").alias("toxic"), F.sum(1 - F.col("label")).alias("ordinary")
    )
    sizes = {r.label: r["count"] for r in rows.filter("half = 0").groupBy("label").count().collect()}
    dictionaries = _dictionaries(materialise(counted, "words"), [sizes.get(label, 0) for label in (0, 1)])
    return _calibrated(spark, ToxicityModel(*dictionaries, share=share), rows.filter("half = 1"), counts)


def _dictionaries(counted: DataFrame, documents: list[int]) -> tuple[bytes, bytes]:
    """Dictionaries of toxic and ordinary words, from the words' document counts."""
    n0, n1 = max(documents[0], 1), max(documents[1], 1)
    a, b, prior = F.col("toxic"), F.col("ordinary"), n1 / (n1 + n0)
    test = 2 * (
        F.when(a > 0, a * F.log(a / ((a + b) * prior))).otherwise(0.0) + F.when(b > 0, b * F.log(b / ((a + b) * (1 - prior)))).otherwise(0.0)
    )
    over = counted.withColumn("test", test).filter((a / n1 > b / n0) & (F.col("test") > LEAST_EVIDENCE))
    toxic = [(r.word, r.toxic) for r in over.orderBy(F.desc("test"), "word").limit(WORDS).collect()]
    common = [(r.word, r.ordinary) for r in counted.filter("ordinary > 0").orderBy(F.desc("ordinary"), "word").limit(WORDS).collect()]
    return trained_dictionary(toxic, TOXIC_BYTES), trained_dictionary(common, ORDINARY_BYTES)


def _placed_slices(texts: pa.Array) -> Iterator[tuple[int, pa.Array]]:
    at = 0
    for piece in text_slices(texts, SLICE):
        yield at, piece
        at += len(piece)


def _calibrated(spark: SparkSession, model: ToxicityModel, rows: DataFrame, counts: dict[int, int]) -> ToxicityModel:
    shared = spark.sparkContext.broadcast(model)

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for labels, texts in ((b["label"].slice(at, len(t)), t) for b in batches for at, t in _placed_slices(b["text"])):
            owner, codes, words = split_words(texts)
            cut = [word_windows(w) for w in words]
            found = window_cells(shared.value, [w for part in cut for w in part])
            starts = np.cumsum([0, *map(len, cut)])
            label = labels.to_numpy(zero_copy_only=False)[owner]
            for value in (0, 1):
                times = np.bincount(codes[label == value], minlength=len(words))
                cell, at = np.unique(found, return_inverse=True)
                n = np.bincount(at, weights=np.repeat(times, np.diff(starts)), minlength=len(cell)).astype("int64")
                yield pa.RecordBatch.from_arrays([pa.array(cell), pa.array(np.full(len(cell), value)), pa.array(n)], ["cell", "label", "n"])

    tallies = rows.select("text", "label").mapInArrow(cells, "cell long, label long, n long")
    tallies = tallies.groupBy("cell").agg(*[F.sum(F.when(F.col("label") == v, F.col("n")).otherwise(0)).alias(f"n{v}") for v in (0, 1)])
    found = tallies.collect()  # one row per cell
    all0, all1 = max(sum(r.n0 for r in found), 1), max(sum(r.n1 for r in found), 1)
    # a cell that was seen a few times stays near the ratio 1
    prior0, prior1 = CELL_PRIOR * all0 / (all0 + all1), CELL_PRIOR * all1 / (all0 + all1)
    model.ratios = {r.cell: float(np.log((r.n1 + prior1) / all1 / ((r.n0 + prior0) / all0))) for r in found if r.n0 + r.n1}
    evidence = rows.select("label", toxic_evidence(spark, model)(F.col("text")).alias("e")).select("label", "e.high", "e.total").toPandas()
    y = evidence["label"].to_numpy(float)
    weight = np.where(y == 1, counts[1] / max((y == 1).sum(), 1), counts[0] / max((y == 0).sum(), 1))
    x = features(evidence["high"].to_numpy(float), evidence["total"].to_numpy(float))
    model.weights = tuple(fit_logistic(x, y, weight * len(y) / max(weight.sum(), 1e-9)))
    return model


def toxic_evidence(spark: SparkSession, model: ToxicityModel):
    shared = spark.sparkContext.broadcast(model)

    @F.arrow_udf("high double, total double, word string, score double")
    def evidence(texts: pa.Array) -> pa.Array:
        m = shared.value
        if not m.ratios:
            n = len(texts)
            columns = [np.zeros(n), np.zeros(n), [""] * n, np.full(n, m.share)]
        else:
            # some megabytes of text at a time, so that the arrays of words stay small
            parts = [document_evidence(m, piece) for piece in text_slices(texts, SLICE)] or [(np.zeros(0), np.zeros(0), np.zeros(0, dtype=object))]
            high, total, word = (np.concatenate(part) for part in zip(*parts))
            score = 1 / (1 + np.exp(-np.clip(features(high, total) @ np.array(m.weights), -30, 30)))
            columns = [high, total, word, score]
        types = [pa.float64(), pa.float64(), pa.string(), pa.float64()]
        return pa.StructArray.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], ["high", "total", "word", "score"])

    return evidence


def score_documents(docs: DataFrame, model: ToxicityModel, text: str = "text", out: str = "toxicity") -> DataFrame:
    """All columns and a struct: ``score`` (0 to 1), its evidence ``high`` and ``total``, and the ``word`` with the highest."""
    ship_package(docs.sparkSession)
    return docs.withColumn(out, toxic_evidence(docs.sparkSession, model)(text_or_empty(text)))


def learnable(id: Column, folds: int, held_out: int) -> Column:
    """Whether a row may be learned from: crc32 of the id as text, modulo ``folds``, is not ``held_out``."""
    return F.pmod(F.crc32(id.cast("string").cast("binary")), F.lit(folds)) != held_out
