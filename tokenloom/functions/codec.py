"""Text to token ids and back.

Encoding is the only Python step of the library: words arrive as Arrow lists, each distinct word of a batch is
merged once, side by side with the others that are new, and the ids are assembled with Arrow and numpy kernels. Everything before and after stays in the JVM.
"""

from __future__ import annotations

import heapq
import uuid
from array import array
from collections.abc import Callable, Iterable, Iterator
from itertools import repeat
from typing import TypeVar

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tokenloom.constants import BOS, BYTE_IDS, EOS, PAD, SPECIAL_TOKENS, STAND_INS
from tokenloom.functions import bytelevel, pretokens, sequences
from tokenloom.operators.merges import BATCH_WORDS, merge_flat
from tokenloom.session import ship_package

CACHED_WORDS = 500_000
CACHED_WORD_LENGTH = 64
KEPT_CODECS = 4
# Words whose ids are assembled at a time.
SLICE_WORDS = 100_000
# Bytes of text that are split into words at a time.
SLICE_BYTES = 8_000_000
# Distinct words of a slice from which those without a merge are spelled each time: for many words that costs less than a look-up.
SPELLED_WORDS = 1000
# Ids that the pool has room for however few it holds.
SPARE_IDS = 1 << 20
# Ids that a pair of them in one number has room for.
MOST_IDS = 1 << 21

T = TypeVar("T")


def merge_word(ids: list[int], merges: dict[int, tuple[int, int]]) -> list[int]:
    """Apply the lowest-rank merge, leftmost first, until none applies.

    ``merges`` maps ``left << 32 | right`` to ``(rank, new id)``. A linked list and a heap keep long words
    at n log n.
    """
    heap = []
    for i, left in enumerate(ids[:-1]):
        found = merges.get(left << 32 | ids[i + 1])
        if found:
            heap.append((found[0], i, left, ids[i + 1], found[1]))
    if not heap:
        return ids
    heapq.heapify(heap)
    n = len(ids)
    ids = list(ids)
    nxt = list(range(1, n + 1))
    prv = list(range(-1, n - 1))
    while heap:
        _, i, left, right, new = heapq.heappop(heap)
        j = nxt[i]
        if ids[i] != left or j >= n or ids[j] != right:
            continue
        ids[i], ids[j] = new, -1
        k = nxt[i] = nxt[j]
        if k < n:
            prv[k] = i
            found = merges.get(new << 32 | ids[k])
            if found:
                heapq.heappush(heap, (found[0], i, new, ids[k], found[1]))
        p = prv[i]
        if p >= 0:
            found = merges.get(ids[p] << 32 | new)
            if found:
                heapq.heappush(heap, (found[0], p, ids[p], new, found[1]))
    return [t for t in ids if t >= 0]


def _side_by_side(byte_ids: list[int], merges: dict[int, tuple[int, int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray] | None:
    """Sorted pairs with rank and product as ``merge_flat`` takes them; None if it could differ from ``merge_word``.

    It merges all places of a word's best pair before it looks at what they became. That is the same as one place after the other as
    long as no product is part of an earlier merge, which only a merge that spells an older token can break.
    """
    pairs = np.fromiter(merges, np.int64, len(merges))
    ranks, products = np.array(list(merges.values()), np.int64).reshape(-1, 2).T
    # a pair that the list names twice leaves a gap
    ranks = np.argsort(np.argsort(ranks))
    left, right = pairs >> 32, pairs & 0xFFFFFFFF
    ids = np.concatenate([left, right, products, np.array(byte_ids, np.int64)])
    if ids.min() < 0 or ids.max() >= MOST_IDS:
        return None
    used = np.full(MOST_IDS, len(merges), np.int64)
    np.minimum.at(used, left, ranks)
    np.minimum.at(used, right, ranks)
    if (used[products] <= ranks).any():
        return None
    keys = left << 21 | right
    order = np.argsort(keys)
    return keys[order], ranks[order], products[order]


class _WordCodec:
    """Word to ids with a bounded cache, one per Python worker and tokenizer.

    The ids of the words met so far lie one word after the other in an array of int32, the pool, and the cache has the number of each word there.
    ``ends`` has the bytes of the pool before each word.
    """

    def __init__(self, byte_ids: list[int], merges: list[tuple[int, int, int]], specials: dict[str, int]):
        self.byte_ids = byte_ids
        self.merges = {left << 32 | right: (rank, new) for rank, (left, right, new) in enumerate(merges)}
        self.specials = specials
        self.cache: dict[str, int] = {}
        self.tables = _side_by_side(byte_ids, self.merges)
        self.ids = np.array(byte_ids, np.int64)
        # whether two bytes, the first one times 256 plus the second, have a merge
        self.pairs = np.array([a << 32 | b in self.merges for a in byte_ids for b in byte_ids])
        self.pool, self.ends, self.words = np.zeros(1 << 10, np.int32), np.zeros(1 << 8, np.int64), 0

    def word(self, word: str) -> bytes:
        if word in self.specials:
            ids = [self.specials[word]]
        else:
            ids = merge_word([self.byte_ids[b] for b in word.encode()], self.merges)
        return array("i", ids).tobytes()

    def _places(self, distinct: pa.Array) -> np.ndarray:
        """Numbers of words in the pool. Those of words that are not in the cache hold until the next call."""
        self.words = len(self.cache)
        held = self.ends[self.words] // 4
        if len(self.pool) > 4 * held + SPARE_IDS:
            self.pool = self.pool[:held].copy()
        places = np.empty(len(distinct), np.int64)
        spelled = self._unmerged(distinct) if len(distinct) >= SPELLED_WORDS else np.zeros(len(distinct), bool)
        others = np.flatnonzero(~spelled)
        texts = distinct.take(pa.array(others)).to_numpy(zero_copy_only=False)
        places[others] = found = np.fromiter(map(self.cache.get, texts, repeat(-1)), np.int64, len(texts))
        new, texts = others[found < 0], texts[found < 0].tolist()
        long = np.fromiter((len(w) > CACHED_WORD_LENGTH for w in texts), bool, len(texts))
        alone = long | np.fromiter((self.tables is None or w in self.specials for w in texts), bool, len(texts))
        # words that are not kept come last, so that they can go
        for i in range(0, len(new), BATCH_WORDS):
            part = new[i : i + BATCH_WORDS][~alone[i : i + BATCH_WORDS]]
            places[part] = self._merged(*_bytes_of(distinct, part))
        for i in (*np.flatnonzero(alone & ~long), *np.flatnonzero(long)):
            # a long word is merged alone, in n log n
            ids = np.frombuffer(self.word(texts[i]), np.int32)
            places[new[i]] = self._add(ids, np.array([len(ids)]))[0]
        short = np.flatnonzero(~long)
        if len(self.cache) + len(short) > CACHED_WORDS:
            self.cache.clear()
        else:
            self.cache.update(zip(map(texts.__getitem__, short.tolist()), places[new[short]].tolist()))
        spelled = np.flatnonzero(spelled)
        for i in range(0, len(spelled), BATCH_WORDS):
            part = spelled[i : i + BATCH_WORDS]
            data, starts = _bytes_of(distinct, part)
            places[part] = self._add(self.ids[data], np.diff(starts))
        return places

    def _unmerged(self, words: pa.Array) -> np.ndarray:
        """Which words have the ids of their bytes: no two neighbours have a merge."""
        unmerged = [np.zeros(0, bool)]
        for first in range(0, len(words), BATCH_WORDS):
            part = np.arange(first, min(first + BATCH_WORDS, len(words)))
            unmerged.append(~self._merging(*_bytes_of(words, part)))
        reserved = pc.is_in(words, pa.array(list(self.specials), words.type))
        return np.concatenate(unmerged) & ~reserved.to_numpy(zero_copy_only=False)

    def _merging(self, data: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Which words have a merge of two neighbours among their bytes."""
        found = np.zeros(len(data) + 1, np.int32)
        if len(data) > 1:
            found[1:-1] = self.pairs[data[:-1].astype(np.intp) << 8 | data[1:]]
        # pairs across two words do not count
        found[starts] = 0
        found = np.cumsum(found, dtype=np.int32)[starts]
        return found[1:] != found[:-1]

    def _merged(self, data: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Put words given by their bytes into the pool; returns the number of each."""
        changing, sizes = self._merging(data, starts), np.diff(starts)
        symbols, stays = self.ids[data], np.repeat(~changing, sizes)
        places = np.empty(len(sizes), np.int64)
        places[~changing] = self._add(symbols[stays], sizes[~changing])
        if changing.any():
            ids, bounds = merge_flat(symbols[~stays], np.r_[0, np.cumsum(sizes[changing])], *self.tables)
            places[changing] = self._add(ids, np.diff(bounds))
        return places

    def _add(self, ids: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Put words into the pool, their ids and the number of ids of each; returns their numbers there."""
        first, words = self.ends[self.words], self.words + len(sizes)
        self.pool = _grown(self.pool, first // 4 + len(ids))
        self.ends = _grown(self.ends, words + 1)
        self.pool[first // 4 : first // 4 + len(ids)] = ids
        self.ends[self.words + 1 : words + 1] = first + np.cumsum(sizes) * 4
        self.words = words
        return np.arange(words - len(sizes), words)

    def _slices(self, words: pa.Array) -> Iterator[pa.Array]:
        """Lists of words, some at a time; a slice has at least one list."""
        ends = np.cumsum(pc.fill_null(pc.list_value_length(words), 0).to_numpy(zero_copy_only=False))
        first = 0
        while first < len(words):
            before = ends[first - 1] if first else 0
            after = max(int(np.searchsorted(ends, before + SLICE_WORDS, "right")), first + 1)
            yield words.slice(first, after - first)
            first = after

    def encode(self, words: pa.Array) -> pa.Array:
        """Ids of every list of words, made slice by slice."""
        parts = [self._assembled(part) for part in self._slices(words)]
        return pa.concat_arrays(parts) if parts else pa.array([], pa.list_(pa.int32()))

    def round_trip(self, ended: pa.Array, tokens: pa.Array) -> Iterator[pa.Array]:
        """Number of ids of texts whose words have end marks, and the bytes that the ids stand for, some texts at a time."""
        ends, first = np.cumsum(pc.fill_null(pc.binary_length(ended), 0).to_numpy(zero_copy_only=False), dtype=np.int64), 0
        while first < len(ended):
            before = ends[first - 1] if first else 0
            after = max(int(np.searchsorted(ends, before + SLICE_BYTES, "right")), first + 1)
            for part in self._slices(split_words(ended.slice(first, after - first))):
                ids = self._assembled(part)
                yield pa.StructArray.from_arrays([pc.list_value_length(ids), decoded(ids, tokens)], ["n", "bytes"], mask=ids.is_null())
            first = after

    def _assembled(self, words: pa.Array) -> pa.Array:
        coded = words.flatten().dictionary_encode()
        places = self._places(coded.dictionary)
        # the pool as a string of bytes per word: each is copied as a whole
        pool = pa.Array.from_buffers(pa.large_binary(), self.words, [None, pa.py_buffer(self.ends), pa.py_buffer(self.pool)])
        data, ends = _joined(pool.take(pa.array(places[np.asarray(coded.indices)])))
        ids = pa.Array.from_buffers(pa.int32(), ends[-1] // 4, [None, data])
        offsets = (ends[_bounds(words)] // 4).astype(np.int32)
        mask = words.is_null() if words.null_count else None
        return pa.ListArray.from_arrays(pa.array(offsets), ids, mask=mask)


def _bytes_of(strings: pa.Array, some: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of some strings, one after the other, and where each begins, the end included."""
    data, ends = _joined(strings.take(pa.array(some)).cast(pa.large_binary()))
    return np.frombuffer(data, np.uint8)[: ends[-1]], ends


def split_words(ended: pa.Array) -> pa.Array:
    """Lists of the words of texts in the form of :func:`tokenloom.functions.pretokens.ended_words`."""
    ended = ended.cast(pa.large_binary())
    rows = np.frombuffer(ended.buffers()[1], np.int64)[ended.offset : ended.offset + len(ended) + 1]
    data = np.frombuffer(ended.buffers()[2] or b"", np.uint8)[rows[0] : rows[-1]]
    rows = rows - rows[0]
    other = np.zeros(len(ended), bool)
    held = np.flatnonzero(np.diff(rows))
    other[held] = data[rows[held]] == pretokens.OTHER_END
    gone = data == pretokens.WORD_END
    if other.any():
        gone = np.where(np.repeat(other, np.diff(rows)), data == pretokens.OTHER_END, gone)
    marks = np.flatnonzero(gone)
    # where words end without the marks; the first mark of a text with the other ones ends no word
    ends = (marks - np.arange(len(marks)))[~np.isin(marks, rows[:-1][other])] if other.any() else marks - np.arange(len(marks))
    ends = np.r_[0, ends].astype(np.int32)
    words = pa.Array.from_buffers(pa.string(), len(ends) - 1, [None, pa.py_buffer(ends), pa.py_buffer(data[~gone])])
    counts = np.diff(np.searchsorted(marks, rows)) - other
    mask = ended.is_null() if ended.null_count else None
    return pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(counts)].astype(np.int32)), words, mask=mask)


def _grown(held: np.ndarray, size: int) -> np.ndarray:
    """The array with room for so many numbers."""
    if size <= len(held):
        return held
    larger = np.zeros(max(size, len(held) * 3 // 2), held.dtype)
    larger[: len(held)] = held
    return larger


def _bounds(lists: pa.Array) -> np.ndarray:
    """Where each list begins among the items of all, the end included."""
    return np.r_[0, np.cumsum(pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False))]


def _joined(strings: pa.Array) -> tuple[pa.Buffer, np.ndarray]:
    """The bytes of all strings that were just taken, one after the other, and where each begins, the end included."""
    _, ends, data = strings.buffers()
    return data or pa.py_buffer(b""), np.frombuffer(ends, np.int64)[: len(strings) + 1] if len(strings) else np.zeros(1, np.int64)


def decoded(ids: pa.Array, tokens: pa.Array) -> pa.Array:
    """Bytes that every list of ids stands for; ``tokens`` are those of each token by id. An id beyond them is an error."""
    data, ends = _joined(tokens.take(ids.flatten()))
    return pa.Array.from_buffers(pa.large_binary(), len(ids), [None, pa.py_buffer(ends[_bounds(ids)]), data]).cast(pa.binary())


_codecs: dict[str, _WordCodec] = {}
_token_bytes: dict[str, pa.Array] = {}


def _kept(held: dict[str, T], name: str, make: Callable[[], T]) -> T:
    """What a worker has under a name, made if it is not there; few of them are kept."""
    if name not in held:
        if len(held) >= KEPT_CODECS:
            held.clear()
        held[name] = make()
    return held[name]


class Encoder:
    """Tokenizer tables in the form that tasks need; at most one entry per vocabulary token."""

    def __init__(
        self,
        spark: SparkSession,
        merges: Iterable[tuple[int, int, int]],
        byte_ids: list[int] = BYTE_IDS,
        specials: list[str] | dict[str, int] = SPECIAL_TOKENS,
    ):
        merges = [tuple(m[:3]) for m in merges]
        if len(merges) > bytelevel.MAX_SYMBOLS:
            raise ValueError("more merges than token ids")
        by_token = specials if isinstance(specials, dict) else {t: i for i, t in enumerate(specials)}
        self.bos, self.eos, self.pad = (by_token[SPECIAL_TOKENS[i]] for i in (BOS, EOS, PAD))
        ship_package(spark)
        name = uuid.uuid4().hex
        tables = spark.sparkContext.broadcast((list(byte_ids), merges, by_token))

        @F.arrow_udf("array<int>")
        def encode(words: pa.Array) -> pa.Array:
            return _kept(_codecs, name, lambda: _WordCodec(*tables.value)).encode(words)

        def round_trip(tokens: list[str]) -> Callable[[Column], Column]:
            id_bytes = spark.sparkContext.broadcast([bytelevel.byte_text(t).encode("latin-1") for t in tokens])
            held = uuid.uuid4().hex

            @F.arrow_udf("struct<n: int, bytes: binary>")
            def back(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
                codec = _kept(_codecs, name, lambda: _WordCodec(*tables.value))
                held_bytes = _kept(_token_bytes, held, lambda: pa.array(id_bytes.value, pa.large_binary()))
                for ended in batches:
                    yield from codec.round_trip(ended, held_bytes)

            return back

        self._encode, self._round_trip = encode, round_trip

    @classmethod
    def from_tables(cls, vocab: DataFrame, merges: DataFrame) -> Encoder:
        """From a vocabulary and a merge table, both bounded by the vocabulary size."""
        rows = vocab.select("id", "token", "kind").limit(bytelevel.MAX_SYMBOLS + 1).collect()
        if len(rows) > bytelevel.MAX_SYMBOLS:
            raise ValueError("the vocabulary has more entries than token ids")
        by_token = {r.token: r.id for r in rows}
        # one more than allowed, so that the check of the constructor can fail
        ordered = merges.orderBy("rank").limit(bytelevel.MAX_SYMBOLS + 1).select("left", "right", "new_id").collect()
        return cls(
            vocab.sparkSession,
            [tuple(r) for r in ordered],
            [by_token[c] for c in STAND_INS],
            {r.token: r.id for r in rows if r.kind == "special"},
        )

    def encode(self, text: Column, template: bool = True) -> Column:
        """Ids of a text, between begin and end id when ``template``."""
        ids = self._encode(pretokens.encode_words(text))
        return sequences.add_bos_eos(ids, self.bos, self.eos) if template else ids

    def round_trip(self, text: Column, tokens: list[str]) -> Column:
        """Number ``n`` of ids of a text and the ``bytes`` that they decode to by ``tokens``, the byte-level token texts by id.

        The same as ``encode`` without template and ``decode_ids`` one after the other, but the ids stay in the Python worker, and the words
        of a text go there as one value.
        """
        return self._round_trip(tokens)(pretokens.ended_words(text))


def decode_ids(ids: Column, tokens: list[str], skip: Iterable[int] = ()) -> Column:
    """Text of an id array.

    ``tokens`` lists the byte-level token texts by id (bounded by the vocabulary size); the ids in ``skip``, such as
    those of the reserved tokens, are dropped. Stand-ins become bytes once per token and not once per character of the texts.
    """
    table = F.split(F.lit(bytelevel.STAND_IN_ZERO.join(map(bytelevel.byte_text, tokens))), bytelevel.STAND_IN_ZERO)
    dropped = list(skip)
    kept = F.filter(ids, lambda i: ~i.isin(dropped)) if dropped else ids
    joined = F.array_join(F.transform(kept, lambda i: F.element_at(table, i + 1)), "")
    return bytelevel.lossy_utf8(F.encode(joined, "ISO-8859-1"))
