"""Ranked lexical search: exact inner-product search of sparse vectors in ball trees.

A document is a sparse vector of term impacts, a query item one of term weights, all whole numbers; the score is their
inner product. Documents go into blocks next to documents with the same strongest term, and each block becomes a ball tree:
a node holds a centroid and the radius around it that covers its documents, and is halved along the line between two far
documents until it is small. No document of a ball scores above ``q . centroid + |q| * radius``, nor above the same taken term by
term, where the radius of a term is the most that a document lies above the centroid in it. For each item the nodes of a
block are opened best first, until the best bound left is below the item's k-th best score so far; only then its subtree is pruned.
Bounds are computed in doubles and widened by more than their rounding error, scores of documents in 64-bit integers.

Only terms of the items matter, so documents keep those. Items are dealt into groups of at most ``VOCABULARY`` terms (or of one
item, if that has more); the terms of a group are what is sent to all tasks, and documents are read once per group.

Defined results: null and empty texts have no terms; a document without any term of an item scores 0 and is not returned; equal
scores go to the smaller id, null ids last; rows that repeat an id are documents, or items, of their own; empty tables give an
empty result; other columns may have any name.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from tokenloom.llm.common import materialise
from tokenloom.llm.minhash import text_slices
from tokenloom.llm.words import coded, split_words
from tokenloom.session import shared_path, ship_package

K = 10
# Percent of the score's length part that does not depend on the length, and that does.
LENGTH_PERCENT = 90
VOCABULARY = 200_000
BLOCK_DOCS, BLOCK_TERMS = 8192, 1_000_000
LEAF = 64
SLICE = 4 << 20

# Letters and digits of ASCII, and every character beyond.
GAPS = np.ones(256, dtype=bool)
GAPS[128:] = False
for _first, _last in (b"09", b"AZ", b"az"):
    GAPS[_first : _last + 1] = False


def _term_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in _parts(batch):
            owner, _, words = split_words(part.column(1), GAPS)
            codes, vocabulary = coded(words)
            pairs = np.unique(owner * np.int64(len(vocabulary) + 1) + codes)
            at, code = pairs // (len(vocabulary) + 1), pairs % (len(vocabulary) + 1)
            yield pa.record_batch([part.column(0).take(pa.array(at)), vocabulary.take(pa.array(code))], ["item", "term"])


def _parts(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    begin = 0
    for piece in text_slices(batch.column(1), SLICE):
        yield batch.slice(begin, len(piece))
        begin += len(piece)


def _count_terms(shared):
    known: dict[bytes, int] = {}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not known:
            known.update((t, i) for i, t in enumerate(shared.value))
        for batch in batches:
            for part in _parts(batch):
                owner, _, words = split_words(part.column(1), GAPS)
                codes, vocabulary = coded(words)
                place = np.array([known.get(t, -1) for t in vocabulary.to_pylist()], np.int64)
                term = place[codes] if len(codes) else codes
                n = np.bincount(owner, minlength=part.num_rows)
                key, tf = np.unique((owner * np.int64(len(known) + 1) + term)[term >= 0], return_counts=True)
                row = key // (len(known) + 1)
                offsets = pa.array(np.r_[0, np.cumsum(np.bincount(row, minlength=part.num_rows))].astype(np.int32))
                terms = pa.ListArray.from_arrays(offsets, pa.array((key % (len(known) + 1)).astype(np.int32)))
                times = pa.ListArray.from_arrays(offsets, pa.array(tf.astype(np.int64)))
                yield pa.record_batch([part.column(0), pa.array(n, pa.int64()), terms, times], ["id", "n", "terms", "tf"])

    return count


class Sparse:
    """Rows of a sparse matrix: columns and values, row after row."""

    def __init__(self, offsets: np.ndarray, columns: np.ndarray, values: np.ndarray):
        self.offsets, self.columns, self.values = offsets, columns, values

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def times(self, dense: np.ndarray, first: int = 0, last: int | None = None) -> np.ndarray:
        """Inner products of the rows from ``first`` to ``last`` with a vector."""
        bounds = self.offsets[first : len(self) + 1 if last is None else last + 1]
        products = self.values[bounds[0] : bounds[-1]] * dense[self.columns[bounds[0] : bounds[-1]]]
        filled = np.flatnonzero(bounds[1:] > bounds[:-1])
        sums = np.zeros(len(bounds) - 1, products.dtype)
        # each row is summed by itself, so its rounding error does not grow with the rows before it
        if len(filled):
            sums[filled] = np.add.reduceat(products, bounds[filled] - bounds[0])
        return sums

    def take(self, rows: np.ndarray) -> Sparse:
        at = _spans(self.offsets, rows)
        return Sparse(np.r_[0, np.cumsum(np.diff(self.offsets)[rows])], self.columns[at], self.values[at])


def _spans(offsets: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Places of all entries of some rows."""
    sizes = np.diff(offsets)[rows]
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(offsets[rows] - (ends - sizes), sizes)


class BallTree:
    """Nodes over a block; the documents of a node follow each other in ``docs``, ``order`` gives their places in the block."""

    def __init__(self, docs: Sparse, width: int, leaf: int = LEAF):
        # columns that the block has, so that dense vectors are as long as it needs
        self.used, columns = np.unique(docs.columns, return_inverse=True)
        docs = Sparse(docs.offsets, columns, docs.values)
        self.width = width
        order = np.arange(len(docs))
        norm = Sparse(docs.offsets, np.zeros(len(columns), np.int64), docs.values.astype(float) ** 2).times(np.ones(1))
        real = Sparse(docs.offsets, docs.columns, docs.values.astype(float))
        nodes, centres = [], []
        stack = [(0, len(docs), -1)]
        while stack:
            low, high, parent = stack.pop()
            rows = order[low:high]
            part = real.take(rows)
            centre = np.bincount(part.columns, part.values, len(self.used)) / (high - low)
            own = float(centre @ centre)
            away = norm[rows] - 2 * part.times(centre) + own
            # distances of sums of squares this large carry an error far below the part added
            radius = math.sqrt(max(float(away.max()), 0.0) + 1e-8 * (float(norm[rows].max()) + own))
            at = len(nodes)
            nodes.append([low, high, radius, -1, -1])
            held = np.flatnonzero(centre)
            top = np.zeros(len(self.used), np.int64)
            np.maximum.at(top, part.columns, docs.values[_spans(docs.offsets, rows)])
            centres.append((held, centre[held], top[held]))
            if parent >= 0:
                nodes[parent][3 if nodes[parent][3] < 0 else 4] = at
            if high - low <= leaf or away.max() <= 1e-8 * (float(norm[rows].max()) + own):
                continue
            # halves along the line from the farthest document to the one farthest from that
            one = np.zeros(len(self.used))
            a = int(away.argmax())
            span = slice(part.offsets[a], part.offsets[a + 1])
            one[part.columns[span]] = part.values[span]
            b = int((norm[rows] - 2 * part.times(one)).argmax())
            span = slice(part.offsets[b], part.offsets[b + 1])
            np.subtract.at(one, part.columns[span], part.values[span])
            order[low:high] = rows[np.argsort(part.times(one), kind="stable")]
            middle = (low + high) // 2
            stack += [(middle, high, at), (low, middle, at)]
        self.order, self.docs = order, docs.take(order)
        self.nodes = nodes
        self.radius = np.array([n[2] for n in nodes])
        offsets = np.r_[0, np.cumsum([len(c) for c, _, _ in centres])]
        columns, means, tops = (np.concatenate(part) for part in zip(*centres))
        self.centres, self.tops = Sparse(offsets, columns, means), Sparse(offsets, columns, tops)

    def search(self, terms: np.ndarray, weights: np.ndarray, k: int, floor: int) -> tuple[np.ndarray, np.ndarray]:
        """Places in the block and exact scores, above 0 and not below ``floor``, that hold the block's ``k`` best."""
        dense = np.zeros(len(self.used), np.int64)
        at = np.searchsorted(self.used, terms)
        held = (at < len(self.used)) & (self.used[np.minimum(at, len(self.used) - 1)] == terms) if len(self.used) else np.zeros(len(terms), dtype=bool)
        if not held.any():
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        dense[at[held]] = weights[held]
        real = dense.astype(float)
        bounds = self.centres.times(real) + math.sqrt(float(real @ real)) * self.radius
        # more than all rounding of the sums above, downwards never
        bounds = bounds + 1e-9 * np.abs(bounds).max() + 1.0
        # centroid and radius of a term make its largest impact, in whole numbers
        bounds = np.minimum(bounds, self.tops.times(dense))
        queue = [(-bounds[0], 0)]
        best: list[int] = []
        places, scores = [], []
        while queue:
            bound, node = heapq.heappop(queue)
            if -bound < floor or -bound < 1:
                break
            low, high, _, left, right = self.nodes[node]
            if left >= 0:
                for child in (left, right):
                    heapq.heappush(queue, (-min(bounds[child], -bound), child))
                continue
            found = self.docs.times(dense, low, high)
            good = np.flatnonzero((found >= max(floor, 1)))
            if not len(good):
                continue
            places.append(low + good)
            scores.append(found[good])
            best = sorted([*best, *found[good].tolist()])[-k:]
            if len(best) == k:
                floor = max(floor, best[0])
        if not places:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        places, scores = np.concatenate(places), np.concatenate(scores)
        last = scores >= floor
        return self.order[places[last]], scores[last]


def _search(shared, k: int):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, width = shared.value
        best: list[list[int]] = [[] for _ in items]
        for block in _blocks(batches):
            ids = block.column(0).to_pylist()
            terms, impacts = (c.combine_chunks() for c in (block.column(1), block.column(2)))
            offsets = np.r_[0, np.cumsum(terms.value_lengths().to_numpy(zero_copy_only=False))].astype(np.int64)
            docs = Sparse(offsets, terms.flatten().to_numpy().astype(np.int64), impacts.flatten().to_numpy())
            tree = BallTree(docs, width)
            rows = []
            for i, (_, term, weight) in enumerate(items):
                floor = best[i][0] if len(best[i]) == k else 1
                places, scores = tree.search(term, weight, k, floor)
                # equal scores: smaller ids first, null last
                found = sorted(zip((-scores).tolist(), [(ids[p] is None, ids[p] or 0) for p in places.tolist()]))[:k]
                best[i] = sorted([*best[i], *[-s for s, _ in found]])[-k:]
                rows += [(i, None if none else id, -s) for s, (none, id) in found]
            if rows:
                number, found, scores = zip(*rows)
                yield pa.record_batch([pa.array([items[i][0] for i in number], pa.int64()), pa.array(found, pa.int64()), pa.array(scores, pa.int64())], ["item", "id", "score"])

    return search


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    held, docs, terms = [], 0, 0
    for batch in batches:
        begin = 0
        for i, size in enumerate(batch.column(1).value_lengths().to_pylist()):
            if docs and (docs == BLOCK_DOCS or terms + size > BLOCK_TERMS):
                yield pa.Table.from_batches([*held, batch.slice(begin, i - begin)])
                held, docs, terms, begin = [], 0, 0, i
            docs, terms = docs + 1, terms + size
        held.append(batch.slice(begin))
    if docs:
        yield pa.Table.from_batches(held)


def _item_groups(items: DataFrame, vocabulary: int) -> tuple[DataFrame, int]:
    """``item, term`` with the number of the group, and how many groups there are."""
    sizes = items.groupBy("item").agg(F.count(F.lit(1)).alias("n"))
    total = sizes.agg(F.sum("n")).first()[0] or 0
    groups = -(-total // vocabulary)
    while groups > 1:
        dealt = sizes.groupBy(F.pmod(F.xxhash64("item"), F.lit(groups)).alias("g")).agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("items"))
        # one item may be larger by itself
        if not dealt.filter((F.col("n") > vocabulary) & (F.col("items") > 1)).limit(1).count():
            break
        groups *= 2
    return items.withColumn("g", F.pmod(F.xxhash64("item"), F.lit(max(groups, 1)))), groups


def search(
    items: DataFrame, docs: DataFrame, k: int = K, item_id: str = "item_id", doc_id: str = "doc_id", text: str = "text", vocabulary: int = VOCABULARY
) -> DataFrame:
    """The ``k`` documents with the highest score above 0 for each item: ``item_id, rank, id, score``."""
    spark = docs.sparkSession
    ship_package(spark)
    texts = lambda df, id: df.select(F.col(f"`{id}`").cast("long").alias("id"), F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text"))
    numbered = materialise(texts(items, item_id).withColumn("item", F.monotonically_increasing_id()), "items")
    terms = materialise(numbered.select("item", "text").mapInArrow(_term_rows, "item long, term binary"), "item-terms")
    dealt, groups = _item_groups(terms, vocabulary)
    path, kind = shared_path(spark, "ranked"), "item long, id long, score long"
    for g in range(groups):
        rows = dealt.filter(F.col("g") == g).collect()
        if rows:
            _search_group(texts(docs, doc_id), rows, k).write.mode("append").parquet(path)
    found = spark.read.schema(kind).parquet(path) if groups else spark.createDataFrame([], kind)
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("id"))
    best = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    names = numbered.select(F.col("item").alias("_item"), F.col("id").alias("item_id"))
    return best.join(names, F.col("item") == F.col("_item")).select("item_id", "rank", "id", "score")


def _search_group(docs: DataFrame, rows: list, k: int) -> DataFrame:
    """Best documents of each task for the items of one group, given as its rows of item and term."""
    spark = docs.sparkSession
    terms = sorted({bytes(r["term"]) for r in rows})
    place = {t: i for i, t in enumerate(terms)}
    counted = materialise(
        docs.mapInArrow(_count_terms(spark.sparkContext.broadcast(terms)), "id long, n long, terms array<int>, tf array<long>"), "term-counts"
    )
    totals = counted.filter("n > 0").agg(F.count(F.lit(1)).alias("docs"), F.coalesce(F.sum("n"), F.lit(0)).alias("terms")).first()
    holders = counted.select(F.explode("terms").alias("t")).groupBy("t").agg(F.count(F.lit(1)).alias("df")).limit(len(terms)).collect()
    weight = np.zeros(len(terms), np.int64)
    for r in holders:
        weight[r["t"]] = math.floor(1000 * math.log((2 * totals["docs"] + 2) / (2 * r["df"] + 1)))
    by_item: dict[int, list[int]] = {}
    for r in rows:
        by_item.setdefault(r["item"], []).append(place[bytes(r["term"])])
    lists = [(item, np.array(sorted(found), np.int64)) for item, found in by_item.items()]
    shared = spark.sparkContext.broadcast(([(item, found, weight[found]) for item, found in lists], len(terms)))
    weights = spark.sparkContext.broadcast(weight)

    @F.arrow_udf("int")
    def strongest(terms: pa.Array, impacts: pa.Array) -> pa.Array:
        flat = terms.flatten().to_numpy()
        offsets = np.r_[0, np.cumsum(terms.value_lengths().to_numpy(zero_copy_only=False))]
        score = weights.value[flat] * impacts.flatten().to_numpy()
        top = np.maximum.reduceat(score, offsets[:-1]) if len(flat) else score
        first = np.flatnonzero(score == np.repeat(top, np.diff(offsets)))
        owner = np.searchsorted(offsets, first, "right") - 1
        return pa.array(flat[first[np.searchsorted(owner, np.arange(len(terms)))]].astype(np.int32))

    length = F.expr(f"{100 - LENGTH_PERCENT} + ({LENGTH_PERCENT} * n * {totals['docs']}L) div {max(totals['terms'], 1)}L")
    scored = counted.filter(F.size("terms") > 0).withColumn("m", length)
    scored = scored.withColumn("impacts", F.expr("transform(tf, t -> (1000000000 * t) div (1000 * t + 8 * m))"))
    near = scored.select("id", "terms", "impacts").withColumn("near", strongest("terms", "impacts"))
    dealt = near.repartitionByRange("near", F.xxhash64("id", "terms")).sortWithinPartitions("near")
    return dealt.select("id", "terms", "impacts").mapInArrow(_search(shared, k), "item long, id long, score long")
