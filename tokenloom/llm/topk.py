"""Exact top-k search by inner product without random access: sorted lists read in step, with bounds on every score.

The vectors are kept in blocks. A block has one sorted list of places and values per component. For a query each list is
read from the end where its products are largest. A row's score lies between two bounds: what was read of it plus, for each
list where it was not met yet, the least product in that list, or the product at the place reached so far. Reading stops when at most
a few rows outside the certain ones have an upper bound that reaches the k-th best lower bound; the scores of what is left are
then resolved from the rows.

Rows go into a block with rows near the same pivot, so that whole blocks fall below the bound at their first reading where the data has
clusters. Pivots are a seeded sample of at most ``PIVOTS`` rows; they decide about speed alone. The k-th best score
among them is also the first bound of a query, so no reading starts from nothing. Queries are taken in groups of a bounded size;
each group is sent to all blocks, so vectors never move but once, into their blocks.

Defined results: a vector that is null or holds a null or a number that is not finite takes no part; shorter vectors count as
if filled up with zeros; an empty vector scores 0 with all. Equal scores go to the smaller id, null ids last. Rows that repeat an id are rows
of their own: each is a query, and a candidate of the other. Scores are exact and ranked as such, those beyond
124 bits as equal; one beyond 64 bits is given as the nearest 64-bit number. An empty table gives an empty result; other columns may have any name.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from tokenloom.llm.common import materialise
from tokenloom.session import shared_path, ship_package

K = 10
SCALE = 1024
# Rows of a block, and components in all of them.
BLOCK_ROWS, BLOCK_VALUES = 2048, 1 << 17
PIVOTS = 256
# Queries of a group on average, and the largest group; a group is a broadcast.
QUERY_ROWS, MOST_QUERIES = 1024, 4096
# The first part read of the lists, as a share of a block; later parts grow by half.
FIRST_PART = 24
_LONG = (-(2**63), 2**63 - 1)
# A score in two parts, since products of large numbers pass 64 bits.
_LOW, _MOST = 2**62 - 1, 2**124
_FOUND = "row long, id long, high long, low long"


def whole_numbers(values: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """floor(scale * x): doubles while they are exact, else integers of any size."""
    values = values.astype(np.float64)
    if len(values) and np.abs(values).max() * scale >= 2.0**52:
        # from 2**53 on every double is an integer
        return np.array([int(v) * scale if abs(v) >= 2**53 else math.floor(v * scale) for v in values.tolist()], dtype=object)
    return np.floor(values * scale)


def _offsets(vectors: pa.Array) -> np.ndarray:
    return np.r_[0, np.cumsum(vectors.value_lengths().to_numpy(zero_copy_only=False))].astype(np.int64)


def _matrix(values: np.ndarray, offsets: np.ndarray, width: int) -> np.ndarray:
    """Rows of the same width, filled up with zeros."""
    sizes = np.diff(offsets)
    table = np.zeros((len(sizes), width), values.dtype)
    table[np.repeat(np.arange(len(sizes)), sizes), np.arange(len(values)) - np.repeat(offsets[:-1], sizes)] = values
    return table


def _usable(df: DataFrame, queries: Column, id: str, vector: str) -> DataFrame:
    """``id``, ``vec`` and whether the row is a query, of the vectors that take part."""
    vec = F.col(f"`{vector}`")
    if not isinstance(df.schema[vector].dataType.elementType, (T.FloatType, T.DoubleType)):
        vec = vec.cast("array<double>")
    rows = df.select(F.col(f"`{id}`").cast("long").alias("id"), vec.alias("vec"), F.coalesce(queries, F.lit(False)).alias("asks"))
    return rows.filter(F.col("vec").isNotNull() & F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))))


def _pivots(rows: DataFrame, pivots: int) -> np.ndarray:
    """A seeded sample of at most ``pivots`` rows and ``BLOCK_VALUES`` components."""
    found = [r["vec"] for r in rows.orderBy(F.xxhash64("id", "vec"), "id").limit(pivots).select("vec").collect()]
    width = max(map(len, found), default=0)
    found = found[: max(BLOCK_VALUES // max(width, 1), 1)]
    offsets = np.r_[0, np.cumsum([len(v) for v in found])].astype(np.int64)
    return _matrix(np.array([x for v in found for x in v], np.float64), offsets, width)


def _nearest(pivots: np.ndarray):
    @F.arrow_udf("int")
    def near(vectors: pa.Array) -> pa.Array:
        found = np.zeros(len(vectors), np.int32)
        values, offsets = vectors.flatten().to_numpy(zero_copy_only=False), _offsets(vectors)
        for at in range(0, len(vectors) if len(pivots) else 0, BLOCK_ROWS):
            part = offsets[at : at + BLOCK_ROWS + 1]
            table = _matrix(values[part[0] : part[-1]].astype(np.float64), part - part[0], max(pivots.shape[1], int(np.diff(part).max(initial=0))))
            # only a choice of blocks, so products too large for a double may be cut
            found[at : at + len(part) - 1] = np.nan_to_num(table[:, : pivots.shape[1]].clip(-1e99, 1e99) @ pivots.clip(-1e99, 1e99).T).argmax(axis=1)
        return pa.array(found)

    return near


def _block(held: list[pa.RecordBatch]) -> pa.RecordBatch:
    table = pa.Table.from_batches(held).combine_chunks()
    numbers, ids, vectors, asks = (c.combine_chunks() for c in table.columns)
    offsets = _offsets(vectors)
    matrix = _matrix(vectors.flatten().to_numpy(zero_copy_only=False), offsets, int(np.diff(offsets).max(initial=0)))
    # one list per component: places of the rows in ascending order of it
    places = np.argsort(matrix, axis=0, kind="stable").T.astype(np.int16)
    flat = [numbers, ids, asks, vectors.values[:0] if not matrix.size else pa.array(matrix.ravel()), pa.array(places.ravel())]
    return pa.record_batch([pa.ListArray.from_arrays(pa.array([0, len(c)], pa.int32()), c) for c in flat], ["rows", "ids", "asks", "vectors", "places"])


def _build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held, values, count = [], 0, 0
    for batch in batches:
        begin = 0
        for i, size in enumerate(batch.column(2).value_lengths().to_pylist()):
            if count and (count == BLOCK_ROWS or values + size > BLOCK_VALUES):
                held.append(batch.slice(begin, i - begin))
                yield _block(held)
                held, values, count, begin = [], 0, 0, i
            values, count = values + size, count + 1
        held.append(batch.slice(begin))
    if count:
        yield _block(held)


def sorted_blocks(rows: DataFrame, pivots: np.ndarray) -> DataFrame:
    """Blocks, one row each: numbers, ids and query marks of its rows, their vectors, and the sorted lists of all components."""
    kind = rows.schema["vec"].dataType.elementType.simpleString()
    near = rows.withColumn("near", _nearest(pivots)("vec"))
    # rows of a pivot are spread by a hash, so a hot pivot is many partitions
    dealt = near.repartitionByRange("near", F.xxhash64("id", "vec", F.lit(1))).sortWithinPartitions("near")
    numbered = dealt.select(F.monotonically_increasing_id().alias("row"), "id", "vec", "asks")
    return numbered.mapInArrow(_build, f"rows array<long>, ids array<long>, asks array<boolean>, vectors array<{kind}>, places array<smallint>")


def search_block(values: np.ndarray, places: np.ndarray, table: np.ndarray, query: np.ndarray, k: int, floor, own: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and exact scores of rows among which are the block's ``k`` best, without rows that score below ``floor``.

    Row ``d`` of ``values`` and ``places`` is the list of component ``d``, ascending. ``own`` is a row to leave out, or -1.
    """
    m, width = table.shape
    used = np.flatnonzero(query[:width] != 0)
    weight = query[used]
    # each list from the end with the largest products
    up = (weight < 0)[:, None]
    met = np.where(up, places[used], places[used][:, ::-1]).astype(np.int64)
    products = np.where(up, values[used], values[used][:, ::-1]) * weight[:, None]
    least = products[:, -1]
    total = np.full(m, least.sum() if len(used) else 0, table.dtype)
    seen = np.zeros((m, len(used)), table.dtype)
    others = np.ones(m, dtype=bool)
    if own >= 0:
        others[own] = False
    count, begin, left = int(others.sum()), 0, np.flatnonzero(others)
    while begin < m and len(used):
        end = min(m, begin + max(begin // 2, m // FIRST_PART, 1))
        part = met[:, begin:end]
        # reading a row raises its lower bound from the least product of the list to its own
        np.add.at(total, part.ravel(), (products[:, begin:end] - least[:, None]).ravel())
        seen[part.ravel(), np.repeat(np.arange(len(used)), end - begin)] = 1
        begin = end
        room = products[:, min(begin, m - 1)] - least
        upper = total + (room.sum() - seen @ room)
        bound = floor
        if count >= k:
            best = np.partition(total[others], count - k)[count - k]
            bound = best if bound is None else max(bound, best)
        if bound is not None:
            left = np.flatnonzero(others & (upper >= bound))
            if len(left) <= 2 * k:
                break
    # what is left is resolved from the rows
    return left, (table[left][:, used] * weight).sum(axis=1)


def _search(shared, k: int, scale: int):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers, queries, floors = shared.value
        # k best scores of each query: those of k real rows bound the k-th best from below
        best = [[] if f is None else [f] * k for f in floors]
        for batch in batches:
            for i in range(batch.num_rows):
                rows, ids, _, flat, places = (c[i].values for c in batch.columns)
                rows, ids, m = rows.to_pylist(), ids.to_pylist(), len(rows)
                at = {r: j for j, r in enumerate(rows)}
                table = whole_numbers(flat.to_numpy(zero_copy_only=False), scale).reshape(m, -1)
                places = places.to_numpy(zero_copy_only=False).reshape(-1, m)
                values = np.take_along_axis(table.T, places.astype(np.int64), 1)
                largest = max(abs(int(table.max(initial=0))), abs(int(table.min(initial=0))))
                for q, query in enumerate(queries):
                    arrays = values, places, table, query
                    # sums of products stay exact in a double below 2**53
                    if largest * max((abs(int(x)) for x in (query.max(initial=0), query.min(initial=0)))) * max(len(query), 1) * 4 >= 2**53:
                        arrays = _integers(values), places, _integers(table), _integers(query)
                    floor = best[q][0] if len(best[q]) == k else None
                    left, scores = search_block(*arrays, k, floor, at.get(numbers[q], -1))
                    found = [(int(s), j) for s, j in zip(scores.tolist(), left.tolist()) if floor is None or s >= floor]
                    if not found:
                        continue
                    # equal scores: smaller ids first, null last
                    found.sort(key=lambda f: (-min(max(f[0], -_MOST), _MOST), ids[f[1]] is None, ids[f[1]]))
                    found = found[:k]
                    best[q] = sorted([*best[q], *[s for s, _ in found if floor is None or s > floor]])[-k:]
                    shown = [min(max(s, -_MOST), _MOST) for s, _ in found]
                    columns = [[numbers[q]] * len(found), [ids[j] for _, j in found], [s >> 62 for s in shown], [s & _LOW for s in shown]]
                    yield pa.record_batch([pa.array(c, pa.int64()) for c in columns], ["row", "id", "high", "low"])

    return search


def _integers(numbers: np.ndarray) -> np.ndarray:
    return np.array([int(x) for x in numbers.ravel().tolist()] or np.zeros(0), dtype=object).reshape(numbers.shape)


def _asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(batch.num_rows):
            rows, ids, asks, vectors, _ = (c[i].values for c in batch.columns)
            width = len(vectors) // len(rows)
            at = np.flatnonzero(asks.to_numpy(zero_copy_only=False))
            picked = vectors.to_numpy(zero_copy_only=False).reshape(len(rows), width)[at]
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(at) + 1) * width, pa.int32()), pa.array(picked.ravel(), vectors.type))
            yield pa.record_batch([rows.take(pa.array(at)), ids.take(pa.array(at)), lists], ["row", "id", "vec"])


def top_k(
    df: DataFrame, queries: Column, k: int = K, id: str = "vec_id", vector: str = "embedding", scale: int = SCALE, pivots: int = PIVOTS
) -> DataFrame:
    """The ``k`` other rows with the highest inner product of ``floor(scale * x)`` for each row where ``queries`` holds.

    Returns ``query_id, rank, id, score``; a query with fewer than ``k`` others has them all.
    """
    spark = df.sparkSession
    ship_package(spark)
    rows = _usable(df, queries, id, vector)
    sample = _pivots(rows, pivots)
    blocks = materialise(sorted_blocks(rows, sample), "blocks")
    asked = blocks.mapInArrow(_asked, f"row long, id long, vec {rows.schema['vec'].dataType.simpleString()}")
    asked = materialise(asked, "queries")
    groups = max(1, -(-asked.count() // QUERY_ROWS))
    grouped = asked.withColumn("g", F.pmod(F.xxhash64("row"), F.lit(groups)))
    path = shared_path(spark, "top-k")
    known = whole_numbers(sample.ravel(), scale).reshape(sample.shape)
    for g in range(groups):
        held = grouped.filter(F.col("g") == g).limit(MOST_QUERIES + 1).collect()
        if len(held) > MOST_QUERIES:
            raise ValueError("queries are dealt unevenly")
        vectors = [whole_numbers(np.array(r["vec"], np.float64), scale) for r in held]
        shared = spark.sparkContext.broadcast(([r["row"] for r in held], vectors, [_first_bound(known, v, k) for v in vectors]))
        blocks.mapInArrow(_search(shared, k, scale), _FOUND).write.mode("append").parquet(path)
    found = spark.read.schema(_FOUND).parquet(path)
    order = Window.partitionBy("row").orderBy(F.desc("high"), F.desc("low"), F.asc_nulls_last("id"))
    best = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    beyond = F.when(F.col("high") > 1, _LONG[1]).when(F.col("high") < -2, _LONG[0])
    best = best.withColumn("score", F.coalesce(beyond, F.shiftleft("high", 62) + F.col("low")))
    # a table of the queries; Spark broadcasts it where it is small
    names = asked.select(F.col("row").alias("_row"), F.col("id").alias("query_id"))
    return best.join(names, F.col("row") == F.col("_row")).select("query_id", "rank", "id", "score")


def _first_bound(sample: np.ndarray, query: np.ndarray, k: int):
    """The k-th best score among the sample, without one row that may be the query itself."""
    if len(sample) <= k or sample.dtype == object or query.dtype == object:
        return None
    width = min(sample.shape[1], len(query))
    scores = sample[:, :width] @ query[:width]
    if np.abs(scores).max() >= 2**52 or np.abs(sample).max(initial=0) * np.abs(query).max(initial=0) * max(width, 1) >= 2**52:
        return None
    same = np.flatnonzero((sample[:, :width] == query[:width]).all(axis=1))[:1]
    return np.sort(np.delete(scores, same))[-k].item()
