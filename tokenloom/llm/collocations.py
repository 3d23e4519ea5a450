"""Phrase collocations: exact phrase counts by multikey three-way quicksort of suffixes, scored by their least likely cut.

A suffix is the word at a place and the words after it in its piece, up to the greatest phrase length. The words are
counted first, globally. A suffix is abandoned if its leading word is infrequent, and cut short at a later infrequent word, as no
phrase holds a word less often than the phrase itself; a bitmap of fixed size, set for the frequent words, decides this where the suffixes
are made (a word that shares its bit with a frequent one goes on, to no harm). Suffixes that agree in all words are summed where
they are made and then sent, as one row, to a place that their leading word names, so that all suffixes of one leading word
meet. A leading word with over 1/``HOT`` of all occurrences (there are fewer than ``HOT``) is sent by its second word as
well, and by the third one if the second is as frequent; no task gets more than a small share of all suffixes.

There the suffixes are put in order by multikey three-way quicksort: around a pivot word the suffixes divide into less, equal and greater,
the equal ones go on with the next word. The size of an equal part is the count of the words it agrees in; any part of less
than ``least`` occurrences is abandoned unsorted.

The counts of both sides of a cut are then looked up; a hot word or phrase is copied over salts for that.

Defined results: null texts are empty; a null language is ``und``; repeated rows count again; an empty table gives an empty result;
other columns may have any name. Scores are computed in decimals of 38 digits, exact for up to 10**16 occurrences of a phrase. Words
and phrases are compared by their UTF-8 bytes. Memory of a task grows with ``SUFFIXES``, not with the table.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window, functions as F

from tokenloom.llm.common import materialise
from tokenloom.llm.minhash import text_slices
from tokenloom.llm.words import byte_set, coded, split_words
from tokenloom.session import ship_package

GAPS = b"\x20\x09"
STOPS = b".,;:!?\x0a\x0b\x0c\x0d"
LENGTH = 3
LEAST = 10
TOP = 2000
INSIDE_PERCENT = 50
# Suffixes that a task sums before it sends them, and that a task sorts.
BUFFERED = 1_000_000
SUFFIXES = 700_000
# Parts up to this size are sorted at once.
SMALL = 4096
HOT = 256
SALTS = 32
# A language's best phrases are first found in so many parts.
RANKED_PARTS = 8
# 1,024 bitmaps of 32,768 bits each.
BITMAPS, BITS = 1024, 32_768
SLICE = 4 << 20


def _slots(lang: str, words: Iterable[bytes]) -> np.ndarray:
    seed = xxhash.xxh32_intdigest(lang.encode())
    return np.fromiter((xxhash.xxh64_intdigest(w, seed) for w in words), np.uint64)


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, pa.Array]]:
    """Texts of one language each, a few megabytes at a time."""
    for batch in batches:
        langs = batch.column(0).dictionary_encode()
        for code, lang in enumerate(langs.dictionary.to_pylist()):
            for piece in text_slices(batch.column(1).filter(pc.equal(langs.indices, code)), SLICE):
                yield lang, piece


def word_counts(docs: DataFrame, gaps: bytes = GAPS, stops: bytes = STOPS) -> DataFrame:
    """``lang, word, n`` and ``slot``, the place of the word in the bitmaps, over ``lang, text``."""
    gap, stop = byte_set(gaps), byte_set(stops)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, texts in _slices(batches):
            codes, vocabulary = coded(split_words(texts, gap, stop)[2])
            n = np.bincount(codes, minlength=len(vocabulary))
            slots = _slots(lang, vocabulary.to_pylist()) % np.uint64(BITMAPS * BITS)
            yield pa.record_batch(
                [pa.array([lang] * len(n)), vocabulary.cast(pa.string()), pa.array(n, pa.int64()), pa.array(slots.astype(np.int32))],
                ["lang", "word", "n", "slot"],
            )

    counted = docs.mapInArrow(count, "lang string, word string, n long, slot int")
    return counted.groupBy("lang", "word").agg(F.sum("n").alias("n"), F.min("slot").alias("slot"))


def _bitmaps(frequent: DataFrame) -> np.ndarray:
    """Which slots hold a frequent word; always ``BITMAPS * BITS`` bits."""
    kept = frequent.groupBy(F.expr(f"slot div {BITS}").alias("at")).agg(F.bitmap_construct_agg(F.col("slot") % BITS).alias("bits"))
    held = np.zeros((BITMAPS, BITS), dtype=bool)
    for row in kept.limit(BITMAPS).collect():
        held[row["at"]] = np.unpackbits(np.frombuffer(bytes(row["bits"]), np.uint8), bitorder="little")
    return held.ravel()


def _equal_rows(columns: Sequence[np.ndarray], weight: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Distinct rows of the columns and the sum of their weights."""
    order = np.lexsort(columns[::-1])
    columns = [np.ascontiguousarray(c[order]) for c in columns]
    new = np.zeros(len(order), dtype=bool)
    new[:1] = True
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    at = np.flatnonzero(new)
    return [c[at] for c in columns], np.add.reduceat(weight[order], at) if len(at) else weight


class _Buffer:
    """Suffixes of one language, summed: numbers of their words in a growing list, ``-1`` after the last."""

    def __init__(self, lang: str, held: np.ndarray, hot: set[bytes], length: int):
        self.lang, self.held, self.hot, self.length = lang, held, hot, length
        self.clear()

    def clear(self) -> None:
        self.parts: list[pa.Array] = []
        self.suffixes: list[np.ndarray] = []
        self.rows = self.words = 0

    def add(self, piece: np.ndarray, words: pa.Array) -> None:
        codes, vocabulary = coded(words)
        slots = _slots(self.lang, vocabulary.to_pylist())
        kept = self.held[(slots % np.uint64(len(self.held))).astype(np.int64)] if len(slots) else np.zeros(0, dtype=bool)
        vocabulary = vocabulary.filter(pa.array(kept))
        codes = np.where(kept[codes], (np.cumsum(kept) - 1)[codes] + self.words, -1)
        table = np.full((len(codes), self.length), -1, np.int64)
        table[:, 0] = codes
        go = codes >= 0
        for j in range(1, self.length):
            go[max(len(go) - j, 0) :] = False
            ahead = np.flatnonzero(go)
            good = (piece[ahead + j] == piece[ahead]) & (codes[ahead + j] >= 0)
            go[ahead[~good]] = False
            table[ahead[good], j] = codes[ahead[good] + j]
        table = table[table[:, 1] >= 0]
        self.parts.append(vocabulary)
        self.words += len(vocabulary)
        self.suffixes.append(table.astype(np.int32))
        self.rows += len(table)

    def flush(self) -> Iterator[pa.RecordBatch]:
        if not self.rows:
            self.clear()
            return
        codes, vocabulary = coded(pa.concat_arrays(self.parts))
        table = np.concatenate(self.suffixes)
        self.clear()
        # 0 stands for no word
        columns, n = _equal_rows(np.where(table >= 0, codes[table] + 1, 0).T, np.ones(len(table), np.int64))
        texts = vocabulary.to_pylist()
        hashes = np.r_[np.zeros(1, np.uint64), _slots(self.lang, texts)]
        hot = np.r_[False, np.fromiter((w in self.hot for w in texts), bool, len(texts))]
        # a phrase whose words but the last are hot is counted on its own, its continuations go further apart
        route, depth = hashes[columns[0]], np.ones(len(n), np.int64)
        apart = np.ones(len(n), dtype=bool)
        shorter = []
        with np.errstate(over="ignore"):
            for j in range(1, self.length):
                apart &= hot[columns[j - 1]] & (columns[j] > 0)
                route = np.where(apart, (route ^ hashes[columns[j]]) * np.uint64(0x9E3779B97F4A7C15), route)
                depth = np.where(apart, j + 1, depth)
                if j + 1 < self.length:
                    on = np.flatnonzero(apart & hot[columns[j]] & (columns[j + 1] > 0))
                    shorter.append((j + 1, on, route[on]))
        words = pa.concat_arrays([pa.array([None], pa.string()), vocabulary.cast(pa.string())])
        yield self._rows(words, columns, n, route, depth)
        for size, at, place in shorter:
            # the route is the same for equal words, so it may be grouped by as well
            heads, total = _equal_rows([*[c[at] for c in columns[:size]], place.view(np.int64)], n[at])
            ended = [*heads[:size], *[np.zeros(len(total), np.int64)] * (self.length - size)]
            yield self._rows(words, ended, total, heads[size].view(np.uint64), np.full(len(total), size, np.int64))

    def _rows(self, words: pa.Array, columns: list[np.ndarray], n: np.ndarray, route: np.ndarray, depth: np.ndarray) -> pa.RecordBatch:
        arrays = [pa.array([self.lang] * len(n), pa.string()), *[words.take(pa.array(c)) for c in columns]]
        arrays += [pa.array(n, pa.int64()), pa.array(route.view(np.int64)), pa.array(depth, pa.int32())]
        return pa.record_batch(arrays, ["lang", *[f"w{j}" for j in range(1, self.length + 1)], "n", "route", "depth"])


def suffixes(docs: DataFrame, held: np.ndarray, hot: dict[str, set[bytes]], gaps: bytes = GAPS, stops: bytes = STOPS, length: int = LENGTH) -> DataFrame:
    """Suffixes of two and more possibly frequent words: ``lang, w1, w2, ..., n``, their ``route``, and ``depth``, the least
    length that all suffixes on the route of their first words can be counted at."""
    gap, stop = byte_set(gaps), byte_set(stops)
    shared = docs.sparkSession.sparkContext.broadcast((np.packbits(held), hot))

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, known = shared.value
        bitmap = np.unpackbits(bits).astype(bool)
        buffers: dict[str, _Buffer] = {}
        for lang, texts in _slices(batches):
            if lang not in buffers:
                buffers[lang] = _Buffer(lang, bitmap, known.get(lang, set()), length)
            _, piece, words = split_words(texts, gap, stop)
            if len(words):
                buffers[lang].add(piece, words)
            # all buffers together are bounded; the largest one goes
            if sum(b.rows + b.words for b in buffers.values()) >= BUFFERED:
                yield from max(buffers.values(), key=lambda b: b.rows + b.words).flush()
        for buffer in buffers.values():
            yield from buffer.flush()

    names = ", ".join(f"w{j} string" for j in range(1, length + 1))
    return docs.mapInArrow(make, f"lang string, {names}, n long, route long, depth int")


def quicksort_counts(keys: list[np.ndarray], weight: np.ndarray, least: int) -> Iterator[tuple[int, int, int]]:
    """Multikey three-way quicksort down to the last key: ``(depth, a row, occurrences)`` of each run of equal keys.

    A negative key ends a row and is in no run. Parts below ``least`` occurrences are abandoned.
    """
    order = np.arange(len(weight))
    stack = [(0, len(order), 0)]
    while stack:
        low, high, depth = stack.pop()
        part = order[low:high]
        if weight[part].sum() < least:
            continue
        if high - low <= SMALL:
            yield from _sorted_counts(keys, weight, part, depth, least)
            continue
        key = keys[depth][part]
        sample = np.sort(key[:: max(len(key) // 64, 1)])
        pivot = sample[len(sample) // 2]
        less, same = part[key < pivot], part[key == pivot]
        order[low:high] = np.concatenate([less, same, part[key > pivot]])
        first, last = low + len(less), low + len(less) + len(same)
        stack += [(low, first, depth), (last, high, depth)]
        total = int(weight[same].sum())
        if pivot >= 0 and total >= least:
            yield depth, int(same[0]), total
            if depth + 1 < len(keys):
                stack.append((first, last, depth + 1))


def _sorted_counts(keys: list[np.ndarray], weight: np.ndarray, part: np.ndarray, depth: int, least: int) -> Iterator[tuple[int, int, int]]:
    """The same for a small part, sorted whole."""
    rest = [k[part] for k in keys[depth:]]
    order = np.lexsort(rest[::-1])
    part, rest = part[order], [k[order] for k in rest]
    new, held = np.zeros(len(part), dtype=bool), np.ones(len(part), dtype=bool)
    new[:1] = True
    for j, key in enumerate(rest):
        new[1:] |= key[1:] != key[:-1]
        held &= key >= 0
        at = np.flatnonzero(new)
        total = np.add.reduceat(weight[part], at)
        for i in np.flatnonzero((total >= least) & held[at]):
            yield depth + j, int(part[at[i]]), int(total[i])


def _numbers(column: pa.ChunkedArray) -> tuple[np.ndarray, pa.Array]:
    """Numbers of the distinct values, ``-1`` for null."""
    found = column.combine_chunks().dictionary_encode()
    found = found.chunk(0) if isinstance(found, pa.ChunkedArray) else found
    return pc.fill_null(found.indices, -1).to_numpy(zero_copy_only=False).astype(np.int32), found.dictionary


def _sort_suffixes(length: int, least: int):
    names = ["lang", *[f"w{j}" for j in range(1, length + 1)]]

    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = list(batches)
        if not held:
            return
        table = pa.Table.from_batches(held)
        del held
        coded = [_numbers(table.column(name)) for name in names]
        weight, depth = table.column("n").to_numpy(), table.column("depth").to_numpy().astype(np.int32)
        del table
        runs = quicksort_counts([depth, *[c for c, _ in coded]], weight, least)
        # runs of the language or the first word say nothing new; a run shorter than its suffixes' depth is not whole here
        runs = [(d - 1, row, n) for d, row, n in runs if d >= 3 and d - 1 >= depth[row]]
        if not runs:
            return
        deep, rows, n = (np.array(c, np.int64) for c in zip(*runs))
        arrays = [values.take(pa.array(codes[rows], pa.int32(), mask=deep < j)) for j, (codes, values) in enumerate(coded)]
        yield pa.record_batch([*arrays, pa.array(n, pa.int64())], [*names, "n"])

    return sort


def frequent_phrases(docs: DataFrame, words: DataFrame, least: int = LEAST, gaps: bytes = GAPS, stops: bytes = STOPS, length: int = LENGTH) -> DataFrame:
    """Phrases of 2 to ``length`` words that occur ``least`` times or more: ``lang, w1, w2, ..., n``.

    ``words`` is the result of :func:`word_counts`.
    """
    spark = docs.sparkSession
    total = words.agg(F.sum("n")).first()[0] or 0
    hot: dict[str, set[bytes]] = {}
    # fewer than HOT rows, since their shares of the total are over 1 / HOT
    for row in words.filter(F.col("n") * HOT > total).select("lang", "word").collect():
        hot.setdefault(row["lang"], set()).add(row["word"].encode())
    held = _bitmaps(words.filter(F.col("n") >= least))
    made = suffixes(docs, held, hot, gaps, stops, length)
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // SUFFIXES))
    names = ", ".join(f"w{j} string" for j in range(1, length + 1))
    return made.repartition(parts, "route").mapInArrow(_sort_suffixes(length, least), f"lang string, {names}, n long")


def _look_up(frame: DataFrame, counts: DataFrame, keys: dict[str, str], name: str, hot_from: int) -> DataFrame:
    """Column ``name``: the count of the row's ``keys`` (column of the frame to column of the counts).

    Keys counted over ``hot_from`` times, of which there are fewer than ``HOT``, are spread over salts.
    """
    right = [F.col(c).alias(f"_{c}") for c in keys.values()]
    hot = counts.filter(F.col("n") > hot_from).select(*right, F.lit(SALTS).alias("_copies"))
    on = [F.col(a) == F.col(f"_{b}") for a, b in keys.items()]
    drop = [f"_{c}" for c in keys.values()]
    marked = frame.join(F.broadcast(hot), on, "left").drop(*drop)
    salt = F.pmod(F.xxhash64(*frame.columns), F.coalesce("_copies", F.lit(1)))
    marked = marked.withColumn("_salt", salt.cast("int")).drop("_copies")
    copies = F.when(F.col("n") > hot_from, SALTS).otherwise(1)
    copied = counts.select(*right, F.col("n").alias(name), F.explode(F.sequence(F.lit(0), copies - 1)).alias("_copy"))
    return marked.join(copied, [*on, F.col("_salt") == F.col("_copy")]).drop(*drop, "_salt", "_copy")


def collocations(
    docs: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST, top: int = TOP, inside_percent: int = INSIDE_PERCENT
) -> DataFrame:
    """The first ``top`` phrases of 2 or 3 words of each language: ``lang, rank, phrase, a, l, r, n, score``.

    Cutting a phrase gives ``score = floor(1000000 * a * a / (l * r))`` of the counts of the whole and of both sides; the lowest
    one counts, of equal ones the first cut. A phrase inside a longer one that makes ``inside_percent`` of its occurrences is left out.
    """
    ship_package(docs.sparkSession)
    languages = F.coalesce(F.col(f"`{lang}`").cast("string"), F.lit("und"))
    docs = docs.select(languages.alias("lang"), F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text"))
    words = materialise(word_counts(docs), "words")
    phrases = materialise(frequent_phrases(docs, words, least), "phrases")
    hot_from = (words.agg(F.sum("n")).first()[0] or 0) // HOT
    words1 = words.filter(F.col("n") >= least).select("lang", F.col("word").alias("w"), "n")
    two, three = phrases.filter("w3 is null").select("lang", "w1", "w2", "n"), phrases.filter("w3 is not null")

    def with_counts(frame: DataFrame, sides: list[tuple[str, DataFrame, dict[str, str]]]) -> DataFrame:
        for name, counts, keys in sides:
            frame = _look_up(frame, counts, {"lang": "lang", **keys}, name, hot_from)
        return frame

    pairs = with_counts(two.withColumnRenamed("n", "a"), [("l", words1, {"w1": "w"}), ("r", words1, {"w2": "w"})])
    triples = with_counts(three.withColumnRenamed("n", "a"), [
        ("l1", words1, {"w1": "w"}), ("r1", two, {"w2": "w1", "w3": "w2"}), ("l2", two, {"w1": "w1", "w2": "w2"}), ("r2", words1, {"w3": "w"}),
    ])
    whole = "cast(a as decimal(19,0)) * cast(a as decimal(19,0)) * 1000000BD"
    sides = "(cast({l} as decimal(19,0)) * cast({r} as decimal(19,0)))"
    score = f"({whole}) div {sides}"
    # the most frequent phrase that a pair lies in
    ends = F.explode(F.array(F.struct(F.col("w1").alias("x"), F.col("w2").alias("y")), F.struct(F.col("w2").alias("x"), F.col("w3").alias("y"))))
    longer = three.select("lang", ends.alias("e"), "n").groupBy(F.col("lang").alias("_lang"), "e.x", "e.y").agg(F.max("n").alias("longest"))
    pairs = pairs.join(longer, (F.col("lang") == F.col("_lang")) & (F.col("w1") == F.col("x")) & (F.col("w2") == F.col("y")), "left")
    kept = F.col("longest").isNull() | (F.col("longest") * 100 < F.col("a") * inside_percent)
    pairs = pairs.filter(kept).select(
        "lang", F.concat_ws(" ", "w1", "w2").alias("phrase"), "a", "l", "r", F.expr(score.format(l="l", r="r")).alias("score")
    )
    triples = triples.withColumn("s1", F.expr(score.format(l="l1", r="r1"))).withColumn("s2", F.expr(score.format(l="l2", r="r2")))
    first = F.col("s1") <= F.col("s2")
    triples = triples.select(
        "lang", F.concat_ws(" ", "w1", "w2", "w3").alias("phrase"), "a", F.when(first, F.col("l1")).otherwise(F.col("l2")).alias("l"),
        F.when(first, F.col("r1")).otherwise(F.col("r2")).alias("r"), F.least("s1", "s2").alias("score"),
    )
    scored = pairs.unionByName(triples)
    best = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # no task orders all phrases of a language: the best of each part first
    salted = scored.withColumn("_salt", F.pmod(F.xxhash64("phrase"), F.lit(RANKED_PARTS)))
    salted = salted.withColumn("_at", F.row_number().over(Window.partitionBy("lang", "_salt").orderBy(*best))).filter(F.col("_at") <= top)
    ranked = salted.drop("_at", "_salt").withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*best))).filter(F.col("rank") <= top)
    sizes = words.groupBy(F.col("lang").alias("_lang")).agg(F.sum("n").alias("n"))
    found = ranked.join(sizes, F.col("lang") == F.col("_lang"))
    return found.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
