"""Removal of repeated byte strings with a distributed merge sort of suffixes.

A byte goes if a string of ``length`` bytes that covers it also starts anywhere else, in its own text or another; strings never
cross texts and are judged on the input. The work:

1. Equal texts are one node. A node with copies is repeated as a whole, the others of its copies need no search.
2. In every stretch of ``length`` bytes the smallest hash of a ``GRAM``-byte string marks an anchor (the last one, if several
   are equal). The choice depends on the stretch alone, so two equal stretches have their anchor in the same place, and only
   anchors whose ``GRAM`` bytes occur at two places or more can lie in a repeated string. They are found by counting hashes.
3. The suffixes at those anchors are sorted in local runs and front-coded (length of the common prefix with the suffix
   before, and the rest), cut at range splitters, and exchanged. A loser tree merges the runs of a range; it carries each
   run's common prefix with the last output, decides by these lengths alone where they differ, and never compares a known prefix again.
   Neighbours that share the anchor's bytes form a group; pairs with ``length`` bytes in common around the anchor give spans.
4. An anchor that occurs at more than ``LARGE`` places, such as a passage in a third of all texts, does not meet in a group:
   128-bit hashes of the strings around it are counted instead, with a partial aggregation.

Texts move once, to the positions found in them. Defined results: a null text is empty; a text shorter than ``length`` stays;
ids may be null or repeat; an empty table gives an empty result; other columns may have any name.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tokenloom.llm.common import materialise, text_or_empty
from tokenloom.llm.minhash import mixed, node_of, text_slices
from tokenloom.session import ship_package

LENGTH = 200
GRAM = 50
LARGE = 256
RANGE_ROWS = 50_000
RUN_ROWS = 50_000
SAMPLE = 8
KEY = 24
SALTS = 64
SLICE = 2 << 20
PIECE = 1 << 17
_BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)


@lru_cache(maxsize=2)
def _powers(base: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse modulo 2 ** 64, and a random number for each byte."""
    with np.errstate(over="ignore"):
        up = np.multiply.accumulate(np.r_[np.uint64(1), np.full(PIECE, base, dtype="uint64")])
        down = np.multiply.accumulate(np.r_[np.uint64(1), np.full(PIECE, pow(base, -1, 1 << 64), dtype="uint64")])
        return up, down, mixed(np.arange(1, 257, dtype="uint64") * np.uint64(base))


def window_hashes(data: np.ndarray, size: int, base: int = _BASES[0]) -> np.ndarray:
    """Hash of the ``size`` bytes at every position that has so many; the data is taken in overlapping pieces."""
    if len(data) < size:
        return np.zeros(0, dtype="uint64")
    up, down, number = _powers(base)
    out = np.empty(len(data) - size + 1, dtype="uint64")
    with np.errstate(over="ignore"):
        for start in range(0, len(out), PIECE - size + 1):
            piece = data[start : start + PIECE]
            sums = np.r_[np.uint64(0), np.cumsum(number[piece] * up[: len(piece)], dtype="uint64")]
            found = mixed((sums[size:] - sums[:-size]) * down[: len(piece) - size + 1])
            out[start : start + len(found)] = found
    return out


def sliding_minimum(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbours, from minima along blocks in both directions."""
    n = len(values) - width + 1
    full = -(-len(values) // width) * width
    padded = np.full(full, np.iinfo("uint64").max, dtype="uint64")
    padded[: len(values)] = values
    rows = padded.reshape(-1, width)
    forward = np.minimum.accumulate(rows, axis=1).ravel()
    backward = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(backward[:n], forward[width - 1 : width - 1 + n])


def anchors(texts: list[bytes], length: int, gram: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Positions and hashes of each text's anchors."""
    sizes = np.array([len(t) for t in texts], dtype="int64")
    data = np.frombuffer(b"".join(texts), dtype="uint8")
    ends = np.cumsum(sizes)
    empty = np.zeros(0, dtype="int64"), np.zeros(0, dtype="uint64")
    if len(data) < length:
        return [empty] * len(texts)
    hashed = window_hashes(data, gram)
    place = np.arange(len(hashed), dtype="uint64")
    value = (hashed & np.uint64(0xFFFFFFFF00000000)) | (np.uint64(0xFFFFFFFF) - place)
    least = sliding_minimum(value, length - gram + 1)
    chosen = (np.uint64(0xFFFFFFFF) - (least & np.uint64(0xFFFFFFFF))).astype("int64")
    # stretches inside one text
    first = np.arange(len(chosen))
    chosen = chosen[first + length <= np.repeat(ends, sizes)[: len(chosen)]]
    chosen = chosen[np.r_[True, chosen[1:] != chosen[:-1]]] if len(chosen) else chosen
    cut = np.searchsorted(chosen, np.r_[0, ends])
    return [(chosen[a:b] - e + n, hashed[chosen[a:b]]) for a, b, e, n in zip(cut[:-1], cut[1:], ends, sizes)]


def _salt(column: str) -> Column:
    return F.pmod(F.xxhash64(column), F.lit(SALTS)).cast("int")


def _each_salt() -> Column:
    return F.explode(F.expr(f"filter(sequence(0, {SALTS - 1}), b -> getbit(salts, b) = 1)"))


_SALTS_SEEN = "bit_or(shiftleft(1L, salt))"


def _anchor_table(docs: DataFrame, id: str, text: str, length: int, gram: int) -> DataFrame:
    @F.arrow_udf("at array<int>, hash array<bigint>")
    def found(values: pa.Array) -> pa.Array:
        rows = [row for piece in text_slices(values, SLICE) for row in anchors([v or b"" for v in piece.to_pylist()], length, gram)]
        columns = [pa.array([at for at, _ in rows], pa.list_(pa.int32())), pa.array([h.view("int64") for _, h in rows], pa.list_(pa.int64()))]
        return pa.StructArray.from_arrays(columns, ["at", "hash"])

    body = text_or_empty(text)
    rows = docs.select(
        F.col(f"`{id}`").alias("id"), node_of(body).alias("node"), F.octet_length(body).cast("long").alias("n_bytes"),
        F.unhex(F.sha2(body, 256)).alias("sha"), found(body.cast("binary")).alias("anchors"),
    )
    return materialise(rows.select("id", "node", "n_bytes", "sha", "anchors.*"), "anchors")


def _repeated_positions(table: DataFrame, nodes: DataFrame) -> DataFrame:
    """``node, low, at, common``: places of anchors that occur at two places or more, and whether at more than ``LARGE``."""
    each = table.select("id", "node", F.explode(F.arrays_zip("at", "hash")).alias("a")).select("id", "node", "a.at", "a.hash")
    each = each.withColumn("salt", _salt("node"))
    place = F.xxhash64("node", "at")
    seen = each.groupBy("hash").agg(
        F.min(place).alias("first"), F.max(place).alias("last"), F.count(F.lit(1)).alias("n"), F.expr(_SALTS_SEEN).alias("salts")
    )
    seen = seen.filter("first != last").select("hash", (F.col("n") > LARGE).alias("common"), "salts").withColumn("salt", _each_salt())
    found = each.join(seen.drop("salts"), ["hash", "salt"]).select("id", "node", "at", "common")
    # of each text the row with the smallest id
    lowest = nodes.select(F.col("node").alias("of"), "low")
    found = found.join(lowest, (F.col("node") == F.col("of")) & F.col("id").eqNullSafe(F.col("low")))
    return found.select("node", "low", "at", "common").distinct()


def _searched(docs: DataFrame, id: str, text: str, positions: DataFrame) -> DataFrame:
    """``node, data, rare, common``: texts with repeated anchors and their places."""
    wanted = positions.groupBy(F.col("node").alias("of"), "low").agg(
        F.sort_array(F.collect_list(F.when(~F.col("common"), F.col("at")))).alias("rare"),
        F.sort_array(F.collect_list(F.when(F.col("common"), F.col("at")))).alias("common"),
    )
    body = text_or_empty(text)
    rows = docs.select(F.col(f"`{id}`").alias("id"), node_of(body).alias("node"), body.cast("binary").alias("data"))
    rows = rows.join(wanted, (F.col("node") == F.col("of")) & F.col("id").eqNullSafe(F.col("low")))
    once = F.row_number().over(Window.partitionBy("node", "id").orderBy(F.lit(0))) == 1
    return materialise(rows.withColumn("once", once).filter("once").select("node", "data", "rare", "common"), "searched")


def _suffixes(batch: pa.RecordBatch, length: int, gram: int) -> Iterator[tuple[bytes, int, bytes, bytes]]:
    """Node, place, the bytes from the anchor on, and the bytes before it in reverse."""
    for node, data, places in zip(batch["node"], batch["data"], batch["rare"]):
        name, value = node.as_py(), data.as_py()
        for at in places.as_py():
            yield name, at, value[at : at + length], value[max(at - length + gram, 0) : at][::-1]


def _common_prefix(a: bytes, b: bytes, known: int) -> int:
    """Length of the common prefix of two byte strings that agree in ``known`` bytes."""
    size = min(len(a), len(b))
    if a[known:size] == b[known:size]:
        return size
    differ = int.from_bytes(a[known:size], "big") ^ int.from_bytes(b[known:size], "big")
    return size - (differ.bit_length() + 7) // 8


def front_coded(rows: list[tuple]) -> list[tuple]:
    """Sorted rows as (common prefix with the row before, rest, ...)."""
    out, last = [], b""
    for node, at, suffix, left in rows:
        shared = _common_prefix(last, suffix, 0)
        out.append((shared, suffix[shared:], node, at, left))
        last = suffix
    return out


class LoserTree:
    """Merge of front-coded sorted runs.

    Each run holds its next suffix and that suffix's common prefix with the last output. Of two runs the one with the longer prefix is
    smaller, without a comparison; with equal prefixes bytes are compared from there on, and the loser's prefix
    becomes its common prefix with the winner.
    """

    def __init__(self, runs: list[list[tuple]]):
        self.runs = [iter(run) for run in runs]
        size = 1
        while size < max(len(runs), 1):
            size *= 2
        self.size, self.head = size, [None] * size
        self.suffix, self.known, self.loser = [b""] * size, [0] * size, [-1] * size
        for i in range(len(runs)):
            self._advance(i, b"")
        self.winner = self._build(1)

    def _advance(self, i: int, last: bytes) -> None:
        row = next(self.runs[i], None) if i < len(self.runs) else None
        self.head[i] = row
        if row is not None:
            # in its run the suffix follows the last output, so the stored prefix holds for it
            self.known[i] = row[0]
            self.suffix[i] = last[: row[0]] + row[1]

    def _play(self, a: int, b: int) -> tuple[int, int]:
        """Winner and loser."""
        if self.head[b] is None:
            return a, b
        if self.head[a] is None:
            return b, a
        if self.known[a] != self.known[b]:
            return (a, b) if self.known[a] > self.known[b] else (b, a)
        shared = _common_prefix(self.suffix[a], self.suffix[b], self.known[a])
        first = self.suffix[a][shared : shared + 1] <= self.suffix[b][shared : shared + 1]
        won, lost = (a, b) if first else (b, a)
        self.known[lost] = shared
        return won, lost

    def _build(self, node: int) -> int:
        if node >= self.size:
            return node - self.size
        won, lost = self._play(self._build(2 * node), self._build(2 * node + 1))
        self.loser[node] = lost
        return won

    def __iter__(self) -> Iterator[tuple[int, bytes, tuple]]:
        """Common prefix with the output before, suffix, and row, in order."""
        while self.head[self.winner] is not None:
            i = self.winner
            row, suffix = self.head[i], self.suffix[i]
            yield self.known[i], suffix, row
            self._advance(i, suffix)
            node = (i + self.size) // 2
            while node:
                i, self.loser[node] = self._play(i, self.loser[node])
                node //= 2
            self.winner = i


def group_spans(group: list[tuple[int, bytes, bytes, int, bytes]], length: int) -> Iterator[tuple[bytes, int, int]]:
    """Spans around the anchors of one group of (prefix shared with the one before, suffix, node, place, left).

    All stretches that an anchor shares with another place contain the anchor, so they join to one span.
    """
    n = len(group)
    reach = [[0, 0] for _ in range(n)]
    for i in range(n):
        right = length
        for j in range(i + 1, n):
            right = min(right, group[j][0])
            left = _common_prefix(group[i][4], group[j][4], 0)
            if left + right >= length:
                for k in (i, j):
                    reach[k][0], reach[k][1] = max(reach[k][0], left), max(reach[k][1], right)
    for (left, right), (_, _, node, at, _) in zip(reach, group):
        if right:
            yield node, at - left, at + right


def _rare_spans(searched: DataFrame, length: int, gram: int) -> DataFrame:
    """Spans from the merge of front-coded runs."""
    spark = searched.sparkSession

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [s[:KEY] for node, at, s, _ in _suffixes(batch, length, gram) if (at + node[0]) % SAMPLE == 0]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.binary())], ["key"])

    total = searched.agg(F.sum(F.size("rare"))).first()[0] or 0
    if not total:
        return spark.createDataFrame([], "node binary, begin long, end long")
    ranges = max(-(-total // RANGE_ROWS), 1)
    sampled = searched.select("node", "data", "rare").mapInArrow(keys, "key binary").repartitionByRange(int(ranges), "key")
    firsts = sampled.groupBy(F.spark_partition_id().alias("range")).agg(F.min("key").alias("key")).collect()  # a row per range
    splitters = spark.sparkContext.broadcast(sorted(r.key for r in firsts)[1:])

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for batch in batches:
            for row in _suffixes(batch, length, gram):
                held.append(row)
                if len(held) >= RUN_ROWS:
                    yield _segments(held, splitters.value)
                    held = []
        if held:
            yield _segments(held, splitters.value)

    def merged(table: pa.Table) -> pa.Table:
        columns = [table[c].to_pylist() for c in ("shared", "rest", "node", "at", "left")]
        tree = LoserTree([list(zip(*segment)) for segment in zip(*columns)])
        out: list[tuple] = []
        group: list[tuple] = []
        for shared, suffix, (_, _, node, at, left) in tree:
            if shared < gram:
                out += group_spans(group, length)
                group = []
            group.append((shared, suffix, node, at, left))
        out += group_spans(group, length)
        kinds = [pa.binary(), pa.int64(), pa.int64()]
        columns = zip(*out) if out else ([], [], [])
        return pa.table([pa.array(c, t) for c, t in zip(columns, kinds)], names=["node", "begin", "end"])

    segment = "range int, shared array<int>, rest array<binary>, node array<binary>, at array<int>, left array<binary>"
    cut = searched.select("node", "data", "rare").mapInArrow(runs, segment)
    return cut.groupBy("range").applyInArrow(merged, "node binary, begin long, end long")


def _segments(rows: list[tuple], splitters: list[bytes]) -> pa.RecordBatch:
    """One sorted run, cut at the splitters; each part is front-coded on its own."""
    rows.sort(key=lambda row: row[2])
    keys = [row[2][:KEY] for row in rows]
    cuts = [0, *[bisect_left(keys, s) for s in splitters], len(rows)]
    parts = [(i, front_coded(rows[a:b])) for i, (a, b) in enumerate(zip(cuts[:-1], cuts[1:])) if b > a]
    kinds = [pa.int32(), pa.binary(), pa.binary(), pa.int32(), pa.binary()]
    columns = [pa.array([i for i, _ in parts], pa.int32())]
    columns += [pa.array([[row[c] for row in part] for _, part in parts], pa.list_(kinds[c])) for c in range(5)]
    return pa.RecordBatch.from_arrays(columns, ["range", "shared", "rest", "node", "at", "left"])


def _common_spans(searched: DataFrame, length: int, gram: int) -> DataFrame:
    """Spans of strings around very frequent anchors, by counting their 128-bit hashes."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for node, data, places in zip(batch["node"], batch["data"], batch["common"]):
                at = places.values.to_numpy().astype("int64")
                value = np.frombuffer(data.as_py(), dtype="uint8")
                starts = np.unique((at[:, None] - np.arange(length - gram + 1)[None, :]).ravel())
                starts = starts[(starts >= 0) & (starts + length <= len(value))]
                one, two = (window_hashes(value, length, base)[starts].view("int64") for base in _BASES)
                columns = [pa.array([node.as_py()] * len(starts), pa.binary()), pa.array(starts), pa.array(one), pa.array(two)]
                yield pa.RecordBatch.from_arrays(columns, ["node", "begin", "one", "two"])

    rows = searched.filter(F.size("common") > 0).select("node", "data", "common")
    each = rows.mapInArrow(hashed, "node binary, begin long, one long, two long").withColumn("salt", _salt("node"))
    each = materialise(each, "strings")
    place = F.xxhash64("node", "begin")
    seen = each.groupBy("one", "two").agg(F.min(place).alias("first"), F.max(place).alias("last"), F.expr(_SALTS_SEEN).alias("salts"))
    seen = seen.filter("first != last").withColumn("salt", _each_salt()).select("one", "two", "salt")
    return each.join(seen, ["one", "two", "salt"]).select("node", "begin", (F.col("begin") + length).alias("end"))


def joined_spans(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Overlapping and touching spans as one."""
    out: list[list[int]] = []
    for begin, end in sorted(spans):
        if out and begin <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([begin, end])
    return [tuple(span) for span in out]


def _cut(searched: DataFrame, spans: DataFrame) -> DataFrame:
    """``node, spans, kept``: texts without the bytes of their spans."""
    lists = spans.groupBy(F.col("node").alias("of")).agg(F.collect_list(F.struct("begin", "end")).alias("spans"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made, kept = [], []
            for data, spans in zip(batch["data"], batch["spans"].to_pylist()):
                value, joined, at, parts = data.as_py(), joined_spans([(s["begin"], s["end"]) for s in spans]), 0, []
                for begin, end in joined:
                    parts.append(value[at:begin])
                    at = end
                kept.append(b"".join([*parts, value[at:]]))
                made.append([{"begin": b, "end": e} for b, e in joined])
            kind = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))
            yield pa.RecordBatch.from_arrays([batch["node"], pa.array(made, kind), pa.array(kept, pa.binary())], ["node", "spans", "kept"])

    rows = searched.select("node", "data").join(lists, F.col("node") == F.col("of")).select("node", "data", "spans")
    return rows.mapInArrow(cut, "node binary, spans array<struct<begin: bigint, end: bigint>>, kept binary")


def remove_repeats(docs: DataFrame, id: str = "doc_id", text: str = "text", length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """``id, n_bytes, spans, kept, kept_sha256``: removed spans, and what is left of a text.

    ``kept`` is null where nothing is removed: the text stays as it is.
    """
    if not 8 <= gram < length:
        raise ValueError("gram must be at least 8 and shorter than length")
    ship_package(docs.sparkSession)
    table = _anchor_table(docs, id, text, length, gram)
    nodes = table.groupBy("node").agg(F.min("id").alias("low"), F.count(F.lit(1)).alias("n"))
    nodes = materialise(nodes, "texts")
    searched = _searched(docs, id, text, _repeated_positions(table, nodes))
    spans = _rare_spans(searched, length, gram).unionByName(_common_spans(searched, length, gram))
    changed = materialise(_cut(searched, spans).withColumnRenamed("node", "of"), "kept")
    answer = nodes.join(changed, F.col("node") == F.col("of"), "left").select("node", "n", "spans", "kept")
    rows = table.select("id", "node", "n_bytes", "sha").withColumn("salt", _salt("id"))
    asked = rows.select("node", "salt").distinct().join(answer, "node")
    found = rows.join(asked, ["node", "salt"])
    whole = (F.col("n") > 1) & (F.col("n_bytes") >= length)
    all_spans = F.array(F.struct(F.lit(0).cast("long").alias("begin"), F.col("n_bytes").alias("end")))
    none = F.array().cast("array<struct<begin: bigint, end: bigint>>")
    spans = F.when(whole, all_spans).otherwise(F.coalesce("spans", none))
    kept = F.when(whole, F.lit(b"")).otherwise(F.col("kept"))
    sha = F.coalesce(F.sha2(kept, 256), F.lower(F.hex("sha")))
    return found.select("id", "n_bytes", spans.alias("spans"), kept.alias("kept"), sha.alias("kept_sha256"))
