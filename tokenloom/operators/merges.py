"""Learning byte-pair merges over a distributed word table.

The plain procedure recounts all pairs, merges the most frequent one (ties: smaller left id, then smaller right
id) and starts again. One pass over the words per merge is far too many, so a round learns as many merges as can be
proven from one count:

* Let S be the best K pairs and the *bar* the pair after them. A pair that appears later sits on the same junction
  between two symbols as a pair counted now, and cannot be more frequent than that. Hence, as long as the best
  pair ranks above the bar, only junctions in S matter.
* Cutting every word at the other junctions leaves short runs of symbols. Grouped and summed, these runs are a
  small table on which the next merges follow exactly, until the best pair no longer ranks above the bar.
* A merge that spells an existing token reuses its id and could raise the count of a pair below the bar. Such a
  merge is only made as the first one of a round, and ends it.

At least the first merge of a round is always exact, so every round makes progress. If the run table is larger
than the driver may hold, K is halved for that round; at K = 1 no table is needed at all.
"""

from __future__ import annotations

import heapq
from collections import defaultdict
from collections.abc import Iterator, Mapping, Sequence
from typing import TYPE_CHECKING, NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame, Row, SparkSession, functions as F

from tokenloom.constants import MIN_FREQUENCY, SPECIAL_TOKENS, STAND_INS, BYTE_IDS, VOCAB_SIZE
from tokenloom.functions import bytelevel
from tokenloom.functions.bytelevel import symbol, symbol_id
from tokenloom.session import shared_path, ship_package

if TYPE_CHECKING:
    from tokenloom.operators.recovery import Base

MERGES_SCHEMA = "rank int, left int, right int, new_id int, count long"

FIRST_PAIRS = 64
MOST_PAIRS = 32_768
# Bounds of the run table on the driver: rows, and symbols in all of them.
MOST_RUNS = 100_000
MOST_SYMBOLS = 4_000_000
CHECKPOINT_EVERY = 8
WORDS_PER_TASK = 100_000
# Words that array kernels work on at a time.
BATCH_WORDS = 20_000
# Each task of a top-k sends k rows to the driver, so their number is limited.
TOP_TASKS = 32


class Merge(NamedTuple):
    left: int
    right: int
    new_id: int
    count: int


class Tokens:
    """Token texts and ids while merges are learned."""

    def __init__(self, vocab_size: int, texts: Mapping[int, str] | None = None):
        if vocab_size > bytelevel.MAX_SYMBOLS:
            raise ValueError(f"vocab_size must not exceed {bytelevel.MAX_SYMBOLS}")
        self.vocab_size = vocab_size
        self.text = dict(texts) if texts else dict(enumerate(SPECIAL_TOKENS)) | dict(zip(BYTE_IDS, STAND_INS))
        self.ids = {t: i for i, t in self.text.items()}
        self.next = max(self.text) + 1

    def full(self) -> bool:
        return self.next >= self.vocab_size

    def product(self, left: int, right: int) -> tuple[int, bool]:
        """Id of a merged token and whether it existed before."""
        text = self.text[left] + self.text[right]
        if text in self.ids:
            return self.ids[text], True
        new = self.next
        self.next += 1
        self.ids[text], self.text[new] = new, text
        return new, False


def _merged(ids: tuple[int, ...], left: int, right: int, new: int) -> tuple[int, ...]:
    out, i = [], 0
    while i < len(ids):
        if ids[i] == left and i + 1 < len(ids) and ids[i + 1] == right:
            out.append(new)
            i += 2
        else:
            out.append(ids[i])
            i += 1
    return tuple(out)


def _follow(
    runs: list[tuple[tuple[int, ...], int]], bar: tuple[int, int, int] | None, tokens: Tokens, min_frequency: int
) -> list[Merge]:
    """Merges that follow exactly from the run table; ``bar`` is ``(-count, left, right)``."""
    counts: dict[tuple[int, int], int] = defaultdict(int)
    places: dict[tuple[int, int], set[int]] = defaultdict(set)
    texts = [r for r, _ in runs]
    for at, (ids, n) in enumerate(runs):
        for pair in zip(ids, ids[1:]):
            counts[pair] += n
            places[pair].add(at)
    heap = [(-n, *pair) for pair, n in counts.items()]
    heapq.heapify(heap)
    learned: list[Merge] = []
    while heap and not tokens.full():
        top = heapq.heappop(heap)
        pair = top[1:]
        n = counts[pair]
        if -top[0] != n:
            continue  # outdated; the pair was pushed again when its count changed
        if n < min_frequency or n < 1 or (bar is not None and top >= bar):
            break
        if learned and tokens.text[pair[0]] + tokens.text[pair[1]] in tokens.ids:
            break
        new, reused = tokens.product(*pair)
        learned.append(Merge(*pair, new, n))
        if reused:
            break
        changed = set()
        for at in sorted(places.pop(pair)):
            before, weight = texts[at], runs[at][1]
            after = _merged(before, *pair, new)
            if after == before:
                continue
            for p in zip(before, before[1:]):
                counts[p] -= weight
                changed.add(p)
            for p in zip(after, after[1:]):
                counts[p] += weight
                places[p].add(at)
                changed.add(p)
            texts[at] = after
        for p in changed:
            if counts[p] > 0:
                heapq.heappush(heap, (-counts[p], *p))
    return learned


def _flat(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all symbols of a batch of symbol strings, and where each word begins, the end included.

    Every symbol lies beyond the basic plane, so it takes four bytes.
    """
    words = words.cast(pa.large_string())
    if not len(words):
        return np.zeros(0, np.int64), np.zeros(1, np.int64)
    bounds = np.frombuffer(words.buffers()[1], np.int64)[words.offset : words.offset + len(words) + 1]
    if bounds[-1] == bounds[0]:
        return np.zeros(0, np.int64), np.zeros(len(words) + 1, np.int64)
    data = np.frombuffer(words.buffers()[2], np.uint8)[bounds[0] : bounds[-1]].reshape(-1, 4).astype(np.int64) & [7, 63, 63, 63]
    return (data << [18, 12, 6, 0]).sum(axis=1) - bytelevel.SYMBOL_BASE, (bounds - bounds[0]) // 4


def _strings(ids: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """Symbol strings of so many ids each."""
    points = ids[:, None] + bytelevel.SYMBOL_BASE
    data = (points >> [18, 12, 6, 0] & [7, 63, 63, 63] | [0xF0, 0x80, 0x80, 0x80]).astype(np.uint8)
    offsets = np.r_[0, np.cumsum(sizes * 4)].astype(np.int64)
    return pa.Array.from_buffers(pa.large_string(), len(sizes), [None, pa.py_buffer(offsets), pa.py_buffer(data.ravel())]).cast(pa.string())


def _junctions(ids: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Both ids at each place between two symbols as one number, -1 between words."""
    keys = ids[:-1] << 21 | ids[1:]
    ends = starts[1:-1]
    keys[ends[(ends > 0) & (ends < len(ids))] - 1] = -1
    return keys


def _keys(pairs: Sequence[str]) -> np.ndarray:
    return np.sort(np.array([symbol_id(p[0]) << 21 | symbol_id(p[1]) for p in pairs], np.int64))


def _among(keys: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Which keys are among ``wanted``, which is sorted."""
    at = np.searchsorted(wanted, keys)
    return wanted[np.minimum(at, len(wanted) - 1)] == keys if len(wanted) else np.zeros(len(keys), dtype=bool)


def _summed(keys: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    at = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, np.int64)
    return keys[at], np.add.reduceat(weights[order], at) if len(at) else weights[:0]


def count_pairs(words: DataFrame) -> DataFrame:
    """Frequency of each adjacent pair of symbols, as :func:`tokenloom.operators.wordstats.pair_strings` gives it.

    Batches are counted with array kernels, so what leaves a batch is a row per distinct pair and not one per junction.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _rebatched(batches, BATCH_WORDS):
            ids, starts = _flat(batch.column(0))
            if len(ids) < 2:
                continue
            keys = _junctions(ids, starts)
            weight = np.repeat(batch.column(1).to_numpy(), np.diff(starts))[:-1]
            pairs, n = _summed(keys[keys >= 0], weight[keys >= 0])
            both = np.stack([pairs >> 21, pairs & (1 << 21) - 1], axis=1).ravel()
            yield pa.record_batch([_strings(both, np.full(len(pairs), 2)), pa.array(n, pa.int64())], ["pair", "n"])

    return words.select("s", "n").mapInArrow(count, "pair string, n long").groupBy("pair").agg(F.sum("n").alias("n"))


def _runs(words: DataFrame, pairs: Sequence[str]) -> DataFrame:
    """Maximal runs of the words whose junctions all lie in ``pairs``, with their frequency, summed per batch."""
    linked = _keys(pairs)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _rebatched(batches, BATCH_WORDS):
            ids, starts = _flat(batch.column(0))
            if len(ids) < 2:
                continue
            held = _among(_junctions(ids, starts), linked)
            edges = np.diff(np.r_[False, held, False].astype(np.int8))
            first, size = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1) - np.flatnonzero(edges == 1) + 1
            at = np.repeat(first - np.cumsum(size) + size, size) + np.arange(size.sum())
            runs = _strings(ids[at], size).dictionary_encode()
            weight = batch.column(1).to_numpy()[np.searchsorted(starts, first, "right") - 1]
            codes, n = _summed(np.asarray(runs.indices.to_numpy(zero_copy_only=False), np.int64), weight)
            yield pa.record_batch([runs.dictionary.take(pa.array(codes)), pa.array(n, pa.int64())], ["run", "n"])

    return words.select("s", "n").mapInArrow(cut, "run string, n long").groupBy("run").agg(F.sum("n").alias("n"))


def _collect_runs(
    words: DataFrame, pairs: Sequence[str], most_runs: int, most_symbols: int
) -> list[tuple[tuple[int, ...], int]] | None:
    """The run table, or None if it is beyond the bounds; it is measured where it lies before any of it is fetched."""
    runs = _runs(words, pairs).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        size = runs.agg(F.count(F.lit(1)).alias("runs"), F.sum(F.length("run")).alias("symbols")).first()
        if size.runs > most_runs or (size.symbols or 0) > most_symbols:
            return None
        return [(tuple(map(symbol_id, r.run)), r.n) for r in runs.collect()]
    finally:
        runs.unpersist()


def _top_pairs(words: DataFrame, count: int) -> list[Row]:
    """The best pairs in merge order."""
    pairs = count_pairs(words)
    if int(words.sparkSession.conf.get("spark.sql.shuffle.partitions")) > TOP_TASKS:
        pairs = pairs.repartition(TOP_TASKS, "pair")
    # a collected top-k would send the k best pairs of every task; with a step after it they meet in one task, and only k rows are sent
    best = pairs.orderBy(F.desc("n"), "pair").limit(count).filter(F.col("n").isNotNull())
    return sorted(best.collect(), key=lambda r: (-r.n, r.pair))


def merge_flat(ids: np.ndarray, starts: np.ndarray, keys: np.ndarray, ranks: np.ndarray, products: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words after their merges, lowest rank first and leftmost first, as ids and word bounds.

    ``keys`` are the merged pairs, sorted, with the rank and the product of each; ranks count up from 0. All words make their next merge
    at the same time, and a word without one is done, so the work falls with the number of words that are still changing. A pair is looked
    up once, and again only where a merge has changed one of its symbols.
    """
    words, none = len(starts) - 1, len(ranks)
    made = np.empty(none, np.int64)
    made[ranks] = products

    def looked_up(at: np.ndarray) -> np.ndarray:
        """Rank of the pair that begins at each place, ``none`` without a merge."""
        if not none:
            return np.full(len(at), none, np.int64)
        after = np.minimum(at + 1, len(ids) - 1)
        pairs = np.where((owner[at] == owner[after]) & (after > at), ids[at] << 21 | ids[after], -1)
        found = np.minimum(np.searchsorted(keys, pairs), none - 1)
        return np.where(keys[found] == pairs, ranks[found], none)

    ids, owner = ids.copy(), np.repeat(np.arange(words), np.diff(starts))
    rank = looked_up(np.arange(len(ids)))
    done = []
    while len(places := np.flatnonzero(rank < none)):
        # the symbols of a word lie together
        of, best = owner[places], rank[places]
        begin = np.flatnonzero(np.r_[True, of[1:] != of[:-1]])
        lowest = np.minimum.reduceat(best, begin)
        places = places[best == np.repeat(lowest, np.diff(np.r_[begin, len(of)]))]
        # of overlapping places, as in a run of one symbol, every second one counts
        run = np.flatnonzero(np.r_[True, np.diff(places) > 1])
        offset = np.arange(len(places)) - np.repeat(run, np.diff(np.r_[run, len(places)]))
        places = places[offset % 2 == 0]
        ids[places] = made[rank[places]]
        kept = np.ones(len(ids), dtype=bool)
        kept[places + 1] = False
        changing = np.zeros(words, dtype=bool)
        changing[of[begin]] = True
        stays = changing[owner]
        done.append((ids[~stays], owner[~stays]))
        stays &= kept
        places = (np.cumsum(stays) - 1)[places]
        ids, owner, rank = ids[stays], owner[stays], rank[stays]
        places = np.concatenate([places, places[places > 0] - 1])
        rank[places] = looked_up(places)
    ids, owner = (np.concatenate(c) for c in zip(*done, (ids, owner)))
    # the symbols of a word come from one part and keep their order
    order = np.argsort(owner, kind="stable")
    return ids[order], np.r_[0, np.cumsum(np.bincount(owner, minlength=words))]


def _rebatched(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """Batches of ``rows`` rows and more; array kernels cost as much for few words as for many."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(b.num_rows for b in held) >= rows:
            yield pa.concat_batches(held)
            held = []
    if held:
        yield pa.concat_batches(held)


def apply_merges(words: DataFrame, merges: Sequence[Merge]) -> DataFrame:
    """Words after the merges of a round; those left with one symbol have no pairs and go.

    An Arrow step: a word costs its own length, while a chain of native replacements would cost every word the number
    of merges. No product of a round is an older token, so lowest rank first equals one merge after the other.
    """
    keys = np.array([m.left << 21 | m.right for m in merges], np.int64)
    ranks = np.argsort(keys)
    keys, products = keys[ranks], np.array([m.new_id for m in merges], np.int64)[ranks]

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _rebatched(batches, BATCH_WORDS):
            ids, starts = merge_flat(*_flat(batch.column(0)), keys, ranks, products)
            sizes = np.diff(starts)
            left = sizes > 1
            yield pa.record_batch([_strings(ids[np.repeat(left, sizes)], sizes[left]), batch.column(1).filter(pa.array(left))], ["s", "n"])

    return words.select("s", "n").mapInArrow(merged, "s string, n long")


def learn_merges(
    words: DataFrame,
    vocab_size: int = VOCAB_SIZE,
    min_frequency: int = MIN_FREQUENCY,
    first_pairs: int = FIRST_PAIRS,
    most_runs: int = MOST_RUNS,
    most_symbols: int = MOST_SYMBOLS,
    rounds: list[int] | None = None,
    base: Base | None = None,
) -> list[Merge]:
    """Merges in the order learned, at most ``vocab_size`` of them.

    With a ``base`` the words are merged by it first, what is learned comes after its merges, and ids go on from its highest one.

    ``words`` holds symbol strings ``s`` with frequency ``n``. The word table is written to the shared folder at the
    start and every few rounds, so a lost executor costs a few narrow steps at most; each copy is removed when the next
    is complete. ``rounds`` collects the number of merges of each round.
    """
    spark = words.sparkSession
    ship_package(spark)
    rounds = [] if rounds is None else rounds
    kept: list[str] = []
    tokens = Tokens(vocab_size, base.texts if base else None)
    learned: list[Merge] = []
    if base:
        renamed = F.translate("s", "".join(map(symbol, BYTE_IDS)), "".join(map(symbol, base.byte_ids)))
        words = apply_merges(words.withColumn("s", renamed), base.merges)
    words = _saved(words.filter(F.length("s") > 1), kept)
    # tasks of even and limited work in every round, whatever the shuffle settings made of the word counts
    tasks = max(spark.sparkContext.defaultParallelism, words.count() // WORDS_PER_TASK)
    words = words.repartition(tasks, "s").persist(StorageLevel.MEMORY_AND_DISK)
    cached = [words]
    wanted = max(1, first_pairs)
    try:
        while not tokens.full():
            top = _top_pairs(words, wanted + 1)
            while len(cached) > 1:
                cached.pop(0).unpersist()
            if not top or top[0].n < min_frequency:
                break
            found = _round(words, top, wanted, tokens, min_frequency, most_runs, most_symbols)
            wanted = found.next_pairs
            learned += found.merges
            rounds.append(len(found.merges))
            words = apply_merges(words, found.merges)
            if len(rounds) % CHECKPOINT_EVERY == 0:
                words = _saved(words, kept)
                while cached:
                    cached.pop().unpersist()
                _remove(spark, kept, 1)
            words = words.persist(StorageLevel.MEMORY_AND_DISK)
            cached.append(words)
    finally:
        for frame in cached:
            frame.unpersist()
        _remove(spark, kept, 0)
    return learned


def _saved(words: DataFrame, kept: list[str]) -> DataFrame:
    """The table, written to the shared folder and read back."""
    path = shared_path(words.sparkSession, "merge-words")
    words.write.parquet(path)
    kept.append(path)
    return words.sparkSession.read.schema(words.schema).parquet(path)


def _remove(spark: SparkSession, kept: list[str], latest: int) -> None:
    """Remove all but the ``latest`` written copies."""
    while len(kept) > latest:
        place = spark._jvm.org.apache.hadoop.fs.Path(kept.pop(0))
        place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(place, True)


class _Round(NamedTuple):
    merges: list[Merge]
    next_pairs: int


def _round(words, top, wanted, tokens, min_frequency, most_runs, most_symbols) -> _Round:
    """Merges of one round and the number of pairs to look at next time."""
    while wanted > 1:
        pairs, bar = top[:wanted], None
        if len(top) > wanted:
            bar = (-top[wanted].n, symbol_id(top[wanted].pair[0]), symbol_id(top[wanted].pair[1]))
        runs = _collect_runs(words, [r.pair for r in pairs], most_runs, most_symbols)
        if runs is not None:
            # after the merges the same number of pairs makes far fewer runs, so there is room to grow
            growth = 4 if len(runs) * 6 <= most_runs else 2 if len(runs) * 3 <= most_runs else 1
            return _Round(_follow(runs, bar, tokens, min_frequency), min(MOST_PAIRS, wanted * growth))
        wanted //= 2
    left, right = map(symbol_id, top[0].pair)
    new, _ = tokens.product(left, right)
    return _Round([Merge(left, right, new, top[0].n)], 2)


def merges_table(spark: SparkSession, merges: Sequence[Merge]) -> DataFrame:
    """Merges as a table; at most one row per vocabulary entry."""
    return spark.createDataFrame([(i, *m) for i, m in enumerate(merges)], MERGES_SCHEMA)
