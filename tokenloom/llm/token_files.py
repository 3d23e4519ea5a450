"""Token files: ids of a fast tokenizer as canonical length-limited Huffman codes, in blocks with bit-offset checkpoints.

Encoding uses the ``tokenizers`` library. A text without white space before a space is cut before each space: no token
of such a byte-level tokenizer crosses that point, so every distinct piece is encoded once and remembered (a bounded memory);
any other text is encoded whole, in long pieces that start at safe boundaries. With ``plain_added`` the
string of a special added token, such as an end mark, is ordinary text; without, as is the library's default and what the
registered query does, it is that token, and a text that holds one is encoded in a single call. Ids are counted over all documents, and package-merge
gives the shortest codes of at most ``LIMIT`` bits. Documents are coded where they are, ordered by id through a range
partitioning of the coded bytes, and written as blocks of whole documents with at least ``BLOCK`` ids.

A file set is a folder with two Parquet tables. ``codes`` has ``token, length``; codes follow from them: shorter first, then by
token. ``blocks`` has ``part, block, start`` (ids of the part before the block), ``docs, counts`` (ids of its documents and their
numbers of tokens), ``offsets`` (first byte of each document in ``bits``; documents start at whole bytes, codes are written from the high bit
down) and ``checkpoints`` (bit offset in ``bits`` of every ``STEP``-th id of each document). Any block, and any checkpoint
in it, decodes on its own. Parts are ranges of ids in ascending order.

Defined results: a null text is empty and holds the end id alone; null ids come first; rows with one id stay all, in no particular
order; an empty table gives empty files.
"""

from __future__ import annotations

import os
from bisect import bisect_right
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema
from tokenizers import Tokenizer

from tokenloom.llm.byte_bpe import pieces
from tokenloom.llm.common import materialise, text_or_empty
from tokenloom.llm.minhash import text_slices
from tokenloom.session import ship_package

LIMIT = 20
BLOCK = 1 << 16
STEP = 1024
TOGETHER = 32
REMEMBERED = 800_000
PIECES = 4096
SLICE = 4 << 20
_SPACE = r"[\t-\r\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000} ] "


@lru_cache(maxsize=2)
def tokenizer(document: str, plain_added: bool) -> Tokenizer:
    # a task has one core; threads of the library would only add work and memory
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    made = Tokenizer.from_str(document)
    made.encode_special_tokens = plain_added
    made.no_truncation()
    made.no_padding()
    return made


@lru_cache(maxsize=2)
def token_bytes(codec: Tokenizer) -> np.ndarray | None:
    """Number of bytes that each token stands for, if every character of a token is one."""
    if codec.normalizer is not None or getattr(codec.pre_tokenizer, "add_prefix_space", None) is not False:
        return None
    vocabulary = codec.get_vocab(with_added_tokens=True)
    sizes = np.zeros(max(vocabulary.values(), default=0) + 1, dtype="int64")
    for token, i in vocabulary.items():
        sizes[i] = len(token)
    return sizes


def encode_one_by_one(codec: Tokenizer, wanted: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    rows = [e.ids for e in codec.encode_batch_fast(wanted.to_pylist(), add_special_tokens=False)]
    lengths = np.fromiter(map(len, rows), dtype="int64", count=len(rows))
    return np.fromiter(chain.from_iterable(rows), dtype="uint32", count=int(lengths.sum())), lengths


def encode_pieces(codec: Tokenizer, wanted: pa.Array, together: int = PIECES) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all pieces and how many each has.

    Pieces that start with a space and end in no white space are a text that may be cut before each of them, so ``together`` of them
    go to the library in one call, and their bytes tell the ids apart. Where a token crosses a piece's end, they go one by one.
    """
    sizes = token_bytes(codec)
    plain = pc.match_substring_regex(wanted, r"^ (?s:.*)[^\s\x0b\x{1c}-\x{1f}\x{85}\p{Z}]$")
    if sizes is None or pc.sum(plain).as_py() in (0, None):
        return encode_one_by_one(codec, wanted)
    spaced, rest = wanted.filter(plain), wanted.filter(pc.invert(plain))
    parts, counts = [], []
    for a in range(0, len(spaced), together):
        some = spaced.slice(a, together)
        ids = np.array(codec.encode_batch_fast(["".join(some.to_pylist())], add_special_tokens=False)[0].ids, dtype="uint32")
        ends = np.r_[0, np.cumsum(sizes[ids])]
        stops = np.r_[0, np.cumsum(pc.binary_length(some).to_numpy(zero_copy_only=False))]
        at = np.searchsorted(ends, stops)
        if ends[-1] == stops[-1] and (ends[at] == stops).all():
            parts.append(ids)
            counts.append(np.diff(at))
        else:
            ids, lengths = encode_one_by_one(codec, some)
            parts.append(ids)
            counts.append(lengths)
    ids, lengths = encode_one_by_one(codec, rest)
    flat, counts = np.concatenate([*parts, ids]), np.concatenate([*counts, lengths])
    # back in the order asked for
    mask = plain.to_numpy(zero_copy_only=False)
    order = np.empty(len(wanted), dtype="int64")
    order[np.r_[np.flatnonzero(mask), np.flatnonzero(~mask)]] = np.arange(len(wanted))
    starts = np.cumsum(counts) - counts
    return gathered(flat, starts[order], counts[order]), counts[order]


class PieceMemory:
    """Ids of pieces already met, as flat arrays; starts afresh when it is full."""

    def __init__(self) -> None:
        self.codec: Tokenizer | None = None
        self.clear()

    def clear(self) -> None:
        self.pieces = pa.array([], pa.large_string())
        self.ids = np.zeros(0, dtype="uint32")
        self.starts = np.zeros(0, dtype="int64")
        self.lengths = np.zeros(0, dtype="int64")

    def places(self, codec: Tokenizer, wanted: pa.Array) -> np.ndarray:
        if self.codec is not codec or len(self.pieces) > REMEMBERED:
            self.codec = codec
            self.clear()
        found = pc.index_in(wanted, value_set=self.pieces)
        new = found.is_null()
        if found.null_count:
            unknown = wanted.filter(new)
            flat, lengths = encode_pieces(codec, unknown)
            ends = len(self.ids) + np.cumsum(lengths)
            first = len(self.pieces)
            self.pieces = pa.concat_arrays([self.pieces, unknown])
            self.ids = np.concatenate([self.ids, flat])
            self.starts, self.lengths = np.r_[self.starts, ends - lengths], np.r_[self.lengths, lengths]
            place = found.fill_null(-1).to_numpy(zero_copy_only=False).astype("int64")
            place[place < 0] = np.arange(first, first + len(unknown))
            return place
        return found.to_numpy(zero_copy_only=False).astype("int64")


_memory = PieceMemory()


def gathered(flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The stretches of ``flat`` one after the other."""
    ends = np.cumsum(lengths)
    return flat[np.repeat(starts - ends + lengths, lengths) + np.arange(ends[-1] if len(ends) else 0)]


def holds_added(codec: Tokenizer, texts: pa.Array) -> np.ndarray:
    """Texts that hold the string of an added token, unless such strings are ordinary text."""
    found = np.zeros(len(texts), dtype=bool)
    for token in codec.get_added_tokens_decoder().values():
        if token.special and codec.encode_special_tokens:
            continue
        found |= pc.match_substring(texts, token.content).to_numpy(zero_copy_only=False)
    return found


def encode_slice(codec: Tokenizer, texts: pa.Array, end: int | None) -> list[np.ndarray]:
    """Ids of each text, with the end id."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    marked = holds_added(codec, texts)
    odd = marked | pc.match_substring_regex(texts, _SPACE).to_numpy(zero_copy_only=False)
    lists = pc.split_pattern(pc.if_else(pa.array(odd), "", texts), " ")
    counts = lists.value_lengths().to_numpy(zero_copy_only=False).astype("int64")
    coded = lists.flatten().dictionary_encode()
    words = coded.dictionary
    codes = coded.indices.to_numpy(zero_copy_only=False).astype("int64")
    # the first piece of a text has no space before it
    first = np.zeros(len(codes), dtype=bool)
    first[(np.cumsum(counts) - counts)[counts > 0]] = True
    codes = np.where(first, codes, codes + len(words))
    occurs = np.zeros(2 * len(words), dtype=bool)
    occurs[codes] = True
    bare, spaced = np.flatnonzero(occurs[: len(words)]), np.flatnonzero(occurs[len(words) :])
    joined = pc.binary_join_element_wise(pa.scalar("", pa.large_string()), words.take(pa.array(spaced)), pa.scalar(" ", pa.large_string()))
    found = _memory.places(codec, pa.concat_arrays([words.take(pa.array(bare)), joined]))
    of = np.zeros(2 * len(words), dtype="int64")
    of[np.flatnonzero(occurs)] = found
    place = of[codes]
    lengths = _memory.lengths[place]
    flat = gathered(_memory.ids, _memory.starts[place], lengths)
    sizes = np.bincount(np.repeat(np.arange(len(counts)), counts), weights=lengths, minlength=len(counts)).astype("int64")
    stops = np.cumsum(sizes)
    tail = np.zeros(0, dtype="uint32") if end is None else np.array([end], dtype="uint32")
    rows = [np.r_[flat[b - n : b], tail] for b, n in zip(stops, sizes)]
    for i in np.flatnonzero(odd):
        text = texts[int(i)].as_py()
        parts = codec.encode_batch_fast([text] if marked[i] else list(pieces(text)), add_special_tokens=False)
        rows[i] = np.r_[np.concatenate([np.array(p.ids, dtype="uint32") for p in parts]), tail].astype("uint32")
    return rows


def encode_documents(
    docs: DataFrame, tokenizer_file: str, id: str = "doc_id", text: str = "text", end: int | None = 2, plain_added: bool = True
) -> DataFrame:
    """``id, ids``: token ids as little-endian unsigned 32-bit integers.

    ``plain_added`` takes the strings of special added tokens in a text as ordinary text, which is not the library's default.
    """
    spark = docs.sparkSession
    ship_package(spark)
    with open(tokenizer_file, encoding="utf-8") as file:
        document = spark.sparkContext.broadcast(file.read())

    @F.arrow_udf("binary")
    def encoded(texts: pa.Array) -> pa.Array:
        codec = tokenizer(document.value, plain_added)
        return pa.array([row.astype("<u4").tobytes() for part in text_slices(texts, SLICE) for row in encode_slice(codec, part, end)], pa.binary())

    return docs.select(F.col(f"`{id}`").alias("id"), encoded(text_or_empty(text)).alias("ids"))


def token_counts(encoded: DataFrame) -> DataFrame:
    """``token, n`` over all documents; each task sends a row per token at most."""

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, dtype="int64")
        for batch in batches:
            flat = np.frombuffer(b"".join(v.as_py() for v in batch["ids"]), dtype="<u4")
            seen = np.bincount(flat, minlength=len(total))
            seen[: len(total)] += total
            total = seen
        token = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(token, pa.int64()), pa.array(total[token], pa.int64())], ["token", "n"])

    return encoded.select("ids").mapInArrow(counts, "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))


def code_lengths(weights: np.ndarray, limit: int = LIMIT) -> np.ndarray:
    """Lengths of an optimal prefix code of at most ``limit`` bits (package-merge)."""
    n = len(weights)
    if n < 2:
        return np.ones(n, dtype="int64")
    limit = max(limit, int(np.ceil(np.log2(n))))
    order = np.argsort(weights, kind="stable")
    leaves = np.asarray(weights, dtype="float64")[order]
    merged, kinds = leaves, [np.ones(n, dtype=bool)]
    for _ in range(limit - 1):
        even = len(merged) // 2 * 2
        packages = merged[:even:2] + merged[1:even:2]
        both = np.r_[leaves, packages]
        by = np.argsort(both, kind="stable")
        merged = both[by]
        kinds.append(by < n)
    lengths, take = np.zeros(n, dtype="int64"), 2 * n - 2
    for leaf in reversed(kinds):
        chosen = int(leaf[:take].sum())
        lengths[:chosen] += 1
        take = 2 * (take - chosen)
    out = np.empty(n, dtype="int64")
    out[order] = lengths
    return out


class Code:
    """Canonical code of tokens with known lengths: shorter codes first, then by token."""

    def __init__(self, tokens: np.ndarray, lengths: np.ndarray):
        order = np.lexsort((tokens, lengths))
        self.tokens, self.sizes = tokens[order], lengths[order]
        self.top = int(self.sizes.max()) if len(tokens) else 1
        room = np.int64(1) << (self.top - self.sizes)
        self.room, starts = room, np.cumsum(room) - room
        size = int(self.tokens.max()) + 1 if len(tokens) else 1
        self.bits, self.length = np.zeros(size, dtype="uint64"), np.zeros(size, dtype="int64")
        self.bits[self.tokens] = (starts >> (self.top - self.sizes)).astype("uint64")
        self.length[self.tokens] = self.sizes

    def tables(self) -> tuple[np.ndarray, np.ndarray]:
        """Token and length for every value of the next ``top`` bits."""
        fill = (1 << self.top) - int(self.room.sum())
        return np.r_[np.repeat(self.tokens, self.room), np.zeros(fill, dtype="int64")], np.r_[np.repeat(self.sizes, self.room), np.ones(fill, dtype="int64")]

    def encode(self, rows: list[np.ndarray], step: int = STEP) -> list[tuple[bytes, np.ndarray]]:
        """Bytes of each row and the bit offsets of every ``step``-th id."""
        counts = np.array([len(r) for r in rows], dtype="int64")
        flat = np.concatenate(rows).astype("int64") if len(rows) else np.zeros(0, dtype="int64")
        length = self.length[flat]
        bits = np.add.reduceat(np.r_[length, 0], np.minimum(np.cumsum(counts) - counts, len(length))) * (counts > 0)
        size = (bits + 7) // 8
        first = np.cumsum(size) - size
        ends = np.cumsum(length)
        own = ends - length  # without the filling of rows to whole bytes
        before = np.r_[0, ends][np.cumsum(counts) - counts]
        at = own + np.repeat(first * 8 - before, counts)
        word, offset = at >> 6, (at & 63).astype("uint64")
        value = self.bits[flat]
        wide = length.astype("uint64")
        words = np.zeros(int(size.sum()) // 8 + 2, dtype="uint64")
        if len(flat):
            starts = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            words[word[starts]] = np.add.reduceat((value << (np.uint64(64) - wide)) >> offset, starts)
            over = np.flatnonzero(offset + wide > 64)
            words[word[over] + 1] |= value[over] << (np.uint64(128) - offset[over] - wide[over])
        data = words.byteswap().tobytes()
        marks = [own[a : a + n : step] - b for a, n, b in zip(np.cumsum(counts) - counts, counts, before)]
        return [(data[a : a + n], m) for a, n, m in zip(first, size, marks)]


def decode_stretches(code_tables: tuple[np.ndarray, np.ndarray], top: int, data: bytes, at: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Ids of stretches that start at the bit offsets ``at``, one after the other; all stretches advance by one id at a time."""
    token, length = code_tables
    padded = data + b"\0" * 8
    ahead = np.ndarray(shape=(len(padded) - 3,), dtype=">u4", buffer=padded, strides=(1,))
    order = np.argsort(-counts, kind="stable")
    place = (np.cumsum(counts) - counts)[order]
    at, left = at[order].astype("int64"), counts[order]
    out = np.empty(int(counts.sum()), dtype="uint32")
    for i in range(int(left[0]) if len(left) else 0):
        k = int(np.searchsorted(-left, -i, side="left"))
        now = at[:k]
        index = ((ahead[now >> 3].astype("int64") << (now & 7)) & 0xFFFFFFFF) >> (32 - top)
        out[place[:k] + i] = token[index]
        now += length[index]
    return out


def decode_blocks(batch: pa.RecordBatch, tables: tuple[np.ndarray, np.ndarray], top: int) -> pa.RecordBatch:
    """Rows ``part, id, start, ids`` of some blocks, whose stretches are decoded side by side."""
    counts = batch["counts"].flatten().to_numpy(zero_copy_only=False).astype("int64")
    docs = batch["counts"].value_lengths().to_numpy(zero_copy_only=False)
    steps = (counts + STEP - 1) // STEP
    last = np.cumsum(steps) - 1
    sizes = np.full(int(steps.sum()), STEP, dtype="int64")
    sizes[last[steps > 0]] = (counts - (steps - 1) * STEP)[steps > 0]
    data = [v.as_py() for v in batch["bits"]]
    before = np.cumsum([0, *map(len, data)])[:-1] * 8
    points = batch["checkpoints"].flatten().to_numpy(zero_copy_only=False).astype("int64")
    points = points + np.repeat(before, batch["checkpoints"].value_lengths().to_numpy(zero_copy_only=False))
    flat = decode_stretches(tables, top, b"".join(data), points, sizes).astype("<u4")
    ends = np.cumsum(counts)
    ids = [flat[b - n : b].tobytes() for b, n in zip(ends, counts)]
    # ids of the block before each document
    opening = np.repeat((np.cumsum(docs) - docs), docs)
    start = np.repeat(batch["start"].to_numpy(zero_copy_only=False), docs) + (ends - counts) - (ends - counts)[opening]
    part = np.repeat(batch["part"].to_numpy(zero_copy_only=False), docs)
    columns = [pa.array(part, pa.int32()), batch["docs"].flatten(), pa.array(start, pa.int64()), pa.array(ids, pa.binary())]
    return pa.RecordBatch.from_arrays(columns, ["part", "id", "start", "ids"])


def _block(rows: list[tuple], part: int, number: int, start: int, schema: pa.Schema) -> pa.RecordBatch:
    ids, counts, bits, marks = zip(*rows)
    offsets = np.cumsum([0, *map(len, bits)])
    points = [8 * int(o) + m for o, row in zip(offsets, marks) for m in row]
    values = [part, number, start, list(ids), list(counts), offsets[:-1].tolist(), points, b"".join(bits)]
    return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(values, schema)], schema=schema)


def write_token_files(encoded: DataFrame, path: str, limit: int = LIMIT, block: int = BLOCK, parts: int | None = None) -> None:
    """Count, code, order and write ``id, ids``; the frame is read twice, so it should be a written table."""
    spark = encoded.sparkSession
    ship_package(spark)
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    counted = token_counts(encoded).orderBy("token").collect()  # a row per token of the vocabulary
    tokens = np.array([r.token for r in counted], dtype="int64")
    lengths = code_lengths(np.array([r.n for r in counted], dtype="int64"), limit)
    table = pa.table({"token": pa.array(tokens, pa.int64()), "length": pa.array(lengths, pa.int64())})
    spark.createDataFrame(table.to_pandas(), "token long, length long").coalesce(1).write.parquet(f"{path}/codes")
    shared = spark.sparkContext.broadcast((tokens, lengths))

    kind = encoded.schema["id"].dataType
    placed = encoded.select("id").repartitionByRange(parts, "id").groupBy(F.spark_partition_id().alias("part"))
    # a row per part: the first id of each but the first
    lows = sorted(r.low for r in placed.agg(F.min("id").alias("low")).collect() if r.low is not None)[1:]
    bounds = spark.sparkContext.broadcast(lows)

    @F.arrow_udf("n int, bits binary, marks array<bigint>, part int")
    def coded(rows: pa.Array, ids: pa.Array) -> pa.Array:
        code = _code(*(a.tobytes() for a in shared.value))
        made, counts = [], []
        for start in range(0, len(rows), 512):
            flat = [np.frombuffer(v.as_py(), dtype="<u4") for v in rows[start : start + 512]]
            made += code.encode(flat)
            counts += map(len, flat)
        part = [0 if i is None else bisect_right(bounds.value, i) for i in ids.to_pylist()]
        columns = [pa.array(counts, pa.int32()), pa.array([b for b, _ in made], pa.binary()), pa.array([m for _, m in made], pa.list_(pa.int64()))]
        return pa.StructArray.from_arrays([*columns, pa.array(part, pa.int32())], ["n", "bits", "marks", "part"])

    before = T.StructType.fromDDL("part int, block int, start long").add("docs", T.ArrayType(kind))
    after = T.StructType.fromDDL("counts array<int>, offsets array<bigint>, checkpoints array<bigint>, bits binary")
    schema = T.StructType(before.fields + after.fields)
    arrow = to_arrow_schema(schema)

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, start, held, rows = TaskContext.get().partitionId(), 0, 0, 0, []
        for batch in batches:
            for row in zip(*[batch[c].to_pylist() for c in ("id", "n", "bits", "marks")]):
                rows.append(row)
                held += row[1]
                if held >= block:
                    yield _block(rows, part, number, start, arrow)
                    number, start, held, rows = number + 1, start + held, 0, []
        if rows:
            yield _block(rows, part, number, start, arrow)

    ready = encoded.select("id", coded("ids", "id").alias("c")).select("id", "c.*")
    ready = ready.repartitionById(len(lows) + 1, F.col("part")).sortWithinPartitions("id")
    ready.select("id", "n", "bits", "marks").mapInArrow(blocks, schema).write.option("compression", "none").parquet(f"{path}/blocks")


@lru_cache(maxsize=2)
def _code(tokens: bytes, lengths: bytes) -> Code:
    return Code(np.frombuffer(tokens, dtype="int64"), np.frombuffer(lengths, dtype="int64"))


@lru_cache(maxsize=1)
def _tables(tokens: bytes, lengths: bytes) -> tuple[np.ndarray, np.ndarray]:
    return _code(tokens, lengths).tables()


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """``id, start, ids``: per document the number of ids before it in the whole set, and its ids (little-endian, 32 bits)."""
    ship_package(spark)
    codes = spark.read.parquet(f"{path}/codes").orderBy("token").toPandas()  # a row per token of the vocabulary
    shared = spark.sparkContext.broadcast((codes["token"].to_numpy("int64"), codes["length"].to_numpy("int64")))
    blocks = spark.read.parquet(f"{path}/blocks")
    kind = blocks.schema["docs"].dataType.elementType
    fields = [("part", T.IntegerType()), ("id", kind), ("start", T.LongType()), ("ids", T.BinaryType())]
    schema = T.StructType([T.StructField(*field) for field in fields])

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = [a.tobytes() for a in shared.value]
        for batch in batches:
            for first in range(0, batch.num_rows, TOGETHER):
                yield decode_blocks(batch.slice(first, TOGETHER), _tables(*key), _code(*key).top)

    sizes = blocks.groupBy("part").agg(F.sum(F.aggregate("counts", F.lit(0).cast("long"), lambda a, n: a + n)).alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # a row per range partition of the writer
    firsts = sizes.select(F.col("part").alias("of"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    rows = blocks.mapInArrow(decoded, schema).join(F.broadcast(firsts), F.col("part") == F.col("of"))
    return rows.select("id", (F.col("first") + F.col("start")).alias("start"), "ids")
