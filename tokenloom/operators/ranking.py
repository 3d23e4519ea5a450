"""Exact samples, splits, chunks and ranks without a global sort.

Every operator here answers "which rows come before position r" for some total order. The order is bucketed; the
bucket counts come from a partial aggregation over the key columns only; a requested position then lies in one
known bucket, and only that bucket's keys are sorted. What comes out are a few *cut keys*, and the full rows are
filtered against them in place: no row payload is shuffled for a sample, a split, a head or a chunk.

A seeded order uses ``md5(seed ':' key)``, so buckets are even whatever the data looks like and every engine with
md5 gives the same order. A positional order uses a numeric column and quantile buckets.

Keys may repeat. The keys of a bucket are counted, so a cut is a key and the number of its copies that come before the
position. Only if that number is not 0 for some cut, the copies of that key are found by a join with the cut keys and numbered by
a hash of the whole row.

Cuts are found when a frame is built, by jobs over the key columns, and kept: whatever is done with the frame then reads the payload once.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from tokenloom.constants import SEED
from tokenloom.session import shared_path

# Cuts of so many subsets may be broadcast; more are joined by subset and salt.
BROADCAST_ROWS = 10_000

# Rows of a subset are spread over so many salts; its cuts are copied for those salts that occur.
SALTS = 64

# Column with the bucket bounds of a positional order.
BOUNDS = "_bounds"

# Rows that one task orders for a full rank; a larger bucket is cut.
MOST_BUCKET_ROWS = 2_000_000

# Buckets of copies of one key, by a hash of the row.
COPY_BUCKETS = 4096

# Hex digits of the hash that make a bucket. Few buckets keep the counting pass small, since every task sends a row
# per bucket; that suits cuts, which sort the keys of one bucket only. A full rank sorts all rows bucket by bucket and
# wants small ones.
CUT_DIGITS = 3
RANK_DIGITS = 4


@dataclass(frozen=True)
class Order:
    """A total order of rows: a sortable key and a coarse bucket that follows it.

    ``bounds`` is a scalar that the bucket needs in a column of its own.
    """

    bucket: Column
    key: Column
    bounds: Column | None = None

    def on(self, df: DataFrame) -> DataFrame:
        return df if self.bounds is None else df.withColumn(BOUNDS, self.bounds)


Positions = Callable[[Column], list[Column]]


def _columns(key: str | Sequence[str]) -> list[Column]:
    return [F.col(k) for k in ([key] if isinstance(key, str) else key)]


def order_hash(key: str | Sequence[str], seed: int = SEED) -> Column:
    """Seeded order key; a composite key is joined with ``:``."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *[c.cast("string") for c in _columns(key)]))


def seeded_order(
    key: str | Sequence[str], seed: int = SEED, digits: int = CUT_DIGITS, first: Column | None = None
) -> Order:
    """Pseudo-random order over ``16 ** digits`` even buckets, within the value of ``first`` if given."""
    if not 1 <= digits <= 6:
        raise ValueError("digits must be between 1 and 6")
    h = order_hash(key, seed)
    prefix = F.substring(h, 1, digits)
    if first is None:
        return Order(prefix, F.struct(h.alias("h"), *_columns(key)))
    return Order(F.struct(first.alias("first"), prefix.alias("prefix")), F.struct(first.alias("first"), h.alias("h"), *_columns(key)))


def positional_order(df: DataFrame, key: str, buckets: int = 1024) -> Order:
    """Order of a numeric column over quantile buckets.

    The quantiles are an estimate, found here by a job, and only affect how even the buckets are; the counts taken over them are
    exact. They are taken in two levels, so that no single task merges the summaries of all input splits.
    """
    kind = df.schema[key].dataType
    if not isinstance(kind, T.NumericType):
        raise TypeError(f"{key} is not numeric")
    steps = [i / buckets for i in range(1, buckets)]
    groups = df.groupBy((F.spark_partition_id() % 256).alias("g")).agg(F.percentile_approx(key, steps, 1000).alias("q"))
    values = groups.select(F.explode("q").alias("v"))
    # at most one number per bucket
    found = values.agg(F.array_sort(F.array_distinct(F.percentile_approx("v", steps))).alias("q")).first().q
    bounds = F.array(*[F.lit(v) for v in found or []]).cast(T.ArrayType(kind))
    # two short searches instead of one long one
    whole = F.size(F.filter(F.filter(BOUNDS, lambda b, i: (i % 32) == 31), lambda b: b <= F.col(key))) * 32
    fine = F.size(F.filter(F.slice(BOUNDS, whole + 1, 32), lambda b: b <= F.col(key)))
    return Order(whole + fine, F.struct(F.col(key)), bounds)


def _bucket_starts(df: DataFrame, order: Order, by: str | None) -> DataFrame:
    """Rows before each bucket and in total; at most one row per bucket (and subset), so one window is small."""
    groups = [by] if by else []
    seen = order.on(df).select(*groups, order.bucket.alias("_bucket"), _salt(order).alias("_salt"))
    counts = seen.groupBy(*groups, "_bucket").agg(F.count(F.lit(1)).alias("_rows"), F.expr("bit_or(shiftleft(1L, _salt))").alias("_bits"))
    whole = Window.partitionBy(*groups)
    upto = whole.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return counts.withColumns({
        "_start": F.sum("_rows").over(upto) - F.col("_rows"), "_total": F.sum("_rows").over(whole),
        "_salts": F.expr("bit_or(_bits)").over(whole),
    }).drop("_bits")


def _salt(order: Order) -> Column:
    return F.pmod(F.xxhash64(order.key), F.lit(SALTS)).cast("int")


def cut_keys(df: DataFrame, order: Order, positions: Positions, by: str | None = None, bounded: bool = True) -> DataFrame:
    """Order keys at the wanted 0-based positions.

    ``positions`` turns the total into a list of positions. One row (per subset): ``_total``, ``_salts`` (bits of the salts
    that occur), ``_cut0`` and ``_copies0`` (how many copies of the cut key come before the position), ``_cut1``, ...; a
    position at or beyond the total has a null cut. ``bounded`` says that the number of subsets is known to be small, so the
    wanted buckets can be broadcast.
    """
    groups = [by] if by else []
    starts = _bucket_starts(df, order, by)
    asked = positions(F.col("_total"))
    wanted = starts.withColumn("_slots", F.array(*[p.cast("long") for p in asked])).select(
        *[F.col(g).alias("_group") for g in groups], "_bucket", "_start", "_rows", "_total", "_salts",
        F.posexplode("_slots").alias("_slot", "_position"),
    )
    wanted = wanted.filter((F.col("_position") >= F.col("_start")) & (F.col("_position") < F.col("_start") + F.col("_rows")))
    wanted = wanted.withColumn("_nth", F.col("_position") - F.col("_start")).drop("_position", "_start", "_rows")
    keys = order.on(df).select(*groups, order.bucket.alias("_b"), order.key.alias("_key"))
    match = F.col("_b") == F.col("_bucket")
    if by:
        match = match & F.col(by).eqNullSafe(F.col("_group"))
    counted = keys.join(F.broadcast(wanted) if bounded else wanted, match)
    counted = counted.groupBy(*groups, "_slot", "_nth", "_total", "_salts", "_key").agg(F.count(F.lit(1)).alias("_n"))
    upto = Window.partitionBy(*groups, "_slot").orderBy("_key").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    hits = (
        counted.withColumn("_copies", F.col("_nth") - F.sum("_n").over(upto) + F.col("_n"))
        .filter((F.col("_copies") >= 0) & (F.col("_copies") < F.col("_n")))
    )
    cuts = [F.max(F.when(F.col("_slot") == i, F.col(c))).alias(f"{name}{i}") for i in range(len(asked)) for c, name in (("_key", "_cut"), ("_copies", "_copies"))]
    return hits.groupBy(*groups).agg(F.max("_total").alias("_total"), F.max("_salts").alias("_salts"), *cuts)


def _inside_copies(cuts: DataFrame) -> Column:
    """Whether the row's key is a cut key with copies on both sides."""
    slots = [c.removeprefix("_copies") for c in cuts.columns if c.startswith("_copies")]
    inside = F.lit(False)
    for i in slots:
        inside = inside | F.coalesce((F.col("_key") == F.col(f"_cut{i}")) & (F.col(f"_copies{i}") > 0), F.lit(False))
    return inside


def _numbered(tied: DataFrame, columns: Sequence[str], by: str | None) -> DataFrame:
    """Column ``_number``, from 1 among the rows of a key (and subset), in the order of a hash of the row.

    Rows are counted in hash buckets first, so the copies of one key are sorted in many tasks.
    """
    group = F.struct(*[F.col(f"`{c}`") for c in ([by] if by else [])], F.col("_key"))
    tied = tied.withColumn("_same", group).withColumn("_tie", F.xxhash64(*[F.col(f"`{c}`") for c in columns]))
    tied = tied.withColumn("_part", F.pmod("_tie", F.lit(COPY_BUCKETS)))
    counts = tied.groupBy(F.col("_same").alias("_of"), F.col("_part").alias("_at")).agg(F.count(F.lit(1)).alias("_n"))
    upto = Window.partitionBy("_of").orderBy("_at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    starts = counts.withColumn("_first", F.sum("_n").over(upto) - F.col("_n")).drop("_n")
    within = F.row_number().over(Window.partitionBy("_same", "_part").orderBy("_tie"))
    placed = tied.join(starts, (F.col("_same") == F.col("_of")) & (F.col("_part") == F.col("_at")))
    return placed.withColumn("_number", F.col("_first") + within).drop("_same", "_tie", "_part", "_of", "_at", "_first")


def _with_cuts(df: DataFrame, order: Order, positions: Positions, by: str | None = None, subsets: Sequence | None = None) -> DataFrame:
    """Rows with ``_total``, the cuts, ``_key`` and ``_number`` (of a copy whose key is a cut, else null).

    Payload is read once and not moved, unless there are more subsets than cuts may be broadcast, or a cut lies inside copies.
    """
    columns = df.columns
    keyed = df.withColumn("_key", order.key)
    if by is None:
        cuts = cut_keys(df, order, positions).drop("_salts")
        cuts = df.sparkSession.createDataFrame(cuts.collect(), cuts.schema)
        # one row, a constant of the plan
        marked = keyed.withColumn("_found", cuts.select(F.struct("*")).scalar())
        rows = marked.select(*[F.col(f"`{c}`") for c in columns], "_key", *[F.col("_found")[c].alias(c) for c in cuts.columns])
        spread = False
    else:
        cuts = cut_keys(df, order, positions, by, bounded=subsets is not None and len(subsets) <= BROADCAST_ROWS)
        cuts = _written(cuts.withColumnRenamed(by, "_group"))
        spread = cuts.limit(BROADCAST_ROWS + 1).count() > BROADCAST_ROWS
        if spread:
            # a hot subset is spread over salts; its cuts are there once for each salt that occurs
            asked = F.explode(F.expr(f"filter(sequence(0, {SALTS - 1}), b -> getbit(_salts, b) = 1)"))
            salted = cuts.withColumn("_salt", asked).drop("_salts")
            on = F.col(by).eqNullSafe(F.col("_group")) & (F.col("_spread") == F.col("_salt"))
            rows = keyed.withColumn("_spread", _salt(order)).join(salted, on, "left").drop("_group", "_salt", "_spread")
        else:
            rows = keyed.join(F.broadcast(cuts.drop("_salts")), F.col(by).eqNullSafe(F.col("_group")), "left").drop("_group")
        cuts = cuts.drop("_salts")
    inside = F.lit(False)
    for c in cuts.columns:
        inside = inside | (F.coalesce(F.col(c), F.lit(0)) > 0) if c.startswith("_copies") else inside
    if cuts.filter(inside).isEmpty():
        return rows.withColumn("_number", F.lit(None).cast("long"))
    tied = rows.filter(_inside_copies(cuts)) if spread else _tied_rows(keyed, cuts, by)
    main = rows.filter(~_inside_copies(cuts)).withColumn("_number", F.lit(None).cast("long"))
    return main.unionByName(_numbered(tied, columns, by))


def _written(table: DataFrame) -> DataFrame:
    """A table of cuts or bucket starts, written once below the shared folder: a narrow row per subset or bucket."""
    path = shared_path(table.sparkSession, "cuts")
    table.write.parquet(path)
    return table.sparkSession.read.schema(table.schema).parquet(path)


def _tied_rows(keyed: DataFrame, cuts: DataFrame, by: str | None) -> DataFrame:
    """Rows whose key is a cut key with copies on both sides; the bounded table of such cuts decides whether anything is read."""
    slots = [c.removeprefix("_copies") for c in cuts.columns if c.startswith("_copies")]
    edges = F.array(*[F.when(F.col(f"_copies{i}") > 0, F.col(f"_cut{i}")) for i in slots])
    edges = cuts.withColumn("_edge", F.explode(F.array_distinct(F.filter(edges, lambda k: k.isNotNull()))))
    on = F.col("_key") == F.col("_edge")
    if by:
        on = on & F.col(by).eqNullSafe(F.col("_group"))
    return keyed.join(F.broadcast(edges), on).drop("_edge", "_group")


def _before(order: Order, slot: int) -> Column:
    """Whether a row comes before a cut; a cut that does not exist lies after all rows."""
    copy = F.coalesce((F.col("_key") == F.col(f"_cut{slot}")) & (F.col("_number") <= F.col(f"_copies{slot}")), F.lit(False))
    return F.coalesce(F.col("_key") < F.col(f"_cut{slot}"), F.lit(True)) | copy


def _only(df: DataFrame, by: str | None, subsets: Sequence | None) -> DataFrame:
    return df if by is None or subsets is None else df.filter(F.col(by).isin(list(subsets)))


def sample_per_subset(
    df: DataFrame, rows: int, by: str, key: str | Sequence[str], seed: int = SEED, subsets: Sequence | None = None
) -> DataFrame:
    """``rows`` random rows of each subset; a smaller subset is kept whole."""
    order = seeded_order(key, seed)
    cut = _with_cuts(_only(df, by, subsets), order, lambda total: [F.lit(rows)], by, subsets)
    return cut.filter(_before(order, 0)).select(*df.columns)


def split_exact(
    df: DataFrame,
    fraction: float,
    key: str | Sequence[str],
    seed: int = SEED,
    by: str | None = None,
    subsets: Sequence | None = None,
) -> DataFrame:
    """Column ``part``: ``test`` for exactly ``ceil(fraction * n)`` random rows (per subset), else ``train``."""
    order = seeded_order(key, seed)
    share = F.lit(Decimal(str(fraction)))
    cut = _with_cuts(_only(df, by, subsets), order, lambda total: [F.ceil(share * total)], by, subsets)
    return cut.withColumn("part", F.when(_before(order, 0), "test").otherwise("train")).select(*df.columns, "part")


def split_hash(df: DataFrame, fraction: float, key: str | Sequence[str], seed: int = SEED) -> DataFrame:
    """Column ``part`` from the row alone, about ``fraction`` in ``test``; works on streams."""
    if not 0 <= fraction <= 1:
        raise ValueError("fraction must be between 0 and 1")
    if fraction == 1:
        return df.withColumn("part", F.lit("test"))
    limit = format(int(Decimal(str(fraction)) * 2**32), "08x")
    head = F.substring(order_hash(key, seed), 1, 8)
    return df.withColumn("part", F.when(head < limit, "test").otherwise("train"))


def head_rows(total: Column, percent: float) -> Column:
    """``percent`` of the total, rounded half to even."""
    return F.bround(F.lit(Decimal(str(percent)) / 100) * total).cast("long")


def chunk_starts(total: Column, chunks: int, percent: float = 100) -> list[Column]:
    """Position after the first ``percent``, then the first positions of all chunks but the first."""
    n = head_rows(total, percent)
    return [n] + [F.floor(n / chunks) * i + F.least(F.lit(i), n % chunks) for i in range(1, chunks)]


def head_fraction(df: DataFrame, percent: float, order: Order) -> DataFrame:
    """First ``percent`` of the rows in an order, rounded half to even."""
    cut = _with_cuts(df, order, lambda total: [head_rows(total, percent)])
    return cut.filter(_before(order, 0)).select(*df.columns)


def corpus_chunks(df: DataFrame, chunks: int, order: Order, compat: bool = False, percent: float = 100) -> DataFrame:
    """Column ``chunk``: contiguous chunks of the first ``percent`` of an order, the first ``n % chunks`` one row longer.

    With ``compat`` every chunk starts at the first row, so a row belongs to several chunks or to none.
    """
    if compat:
        # rows before cut 0 are in every chunk, the row at cut 0 in the longer ones
        def ends(total: Column) -> list[Column]:
            whole = F.floor(head_rows(total, percent) / chunks)
            return [whole, whole + 1]

        rest = (head_rows(F.col("_total"), percent) % chunks).cast("int")
        upto = F.when(_before(order, 0), chunks - 1).when(_before(order, 1), rest - 1).otherwise(-1)
        kept = _with_cuts(df, order, ends).withColumn("_upto", upto).filter("_upto >= 0")
        return kept.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("_upto")))).select(*df.columns, "chunk")

    cut = _with_cuts(df, order, lambda total: chunk_starts(total, chunks, percent)).filter(_before(order, 0))
    passed = [F.when(_before(order, i), 0).otherwise(1) for i in range(1, chunks)]
    return cut.withColumn("chunk", sum(passed, F.lit(0))).select(*df.columns, "chunk")


def with_rank(df: DataFrame, order: Order, before: int | None = None, most: int = MOST_BUCKET_ROWS) -> DataFrame:
    """Column ``rank``: 0-based position in an order, optionally only the rows before a position.

    Buckets wholly beyond ``before`` are dropped ahead of the shuffle. The bucket table has at most ``16 ** digits`` rows
    for a seeded order; it is counted once, and Spark broadcasts it where it is small. Equal keys follow each other by a hash of the
    row. A bucket of over ``most`` rows, as a key in a large part of all rows makes it, is cut into buckets by key and
    that hash, so that only identical rows must meet in one task.
    """
    starts = _written(_bucket_starts(df, order, None).select("_bucket", "_start", "_rows"))
    if before is not None:
        starts = starts.filter(F.col("_start") < before)
    tie = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])
    placed = order.on(df).withColumns({"_b": order.bucket, "_key": order.key, "_tie": tie})
    placed = placed.join(starts, F.col("_b") == F.col("_bucket"))
    if starts.filter(F.col("_rows") > most).isEmpty():
        return _ranked(placed, F.col("_start"), ["_b"], df.columns, before)
    small, large = placed.filter(F.col("_rows") <= most), placed.filter(F.col("_rows") > most)
    large = large.withColumn("_part", F.shiftright("_tie", 58))
    counts = large.groupBy(F.col("_b").alias("_in"), F.col("_key").alias("_of"), F.col("_part").alias("_at")).agg(
        F.count(F.lit(1)).alias("_n"), F.max("_start").alias("_from")
    )
    upto = Window.partitionBy("_in").orderBy("_of", "_at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    counts = counts.withColumn("_first", F.col("_from") + F.sum("_n").over(upto) - F.col("_n")).drop("_n", "_from")
    on = (F.col("_b") == F.col("_in")) & (F.col("_key") == F.col("_of")) & (F.col("_part") == F.col("_at"))
    cut = large.join(counts, on)
    ranked = _ranked(cut, F.col("_first"), ["_b", "_key", "_part"], df.columns, before)
    return _ranked(small, F.col("_start"), ["_b"], df.columns, before).unionByName(ranked)


def _ranked(placed: DataFrame, start: Column, bucket: Sequence[str], columns: Sequence[str], before: int | None) -> DataFrame:
    within = Window.partitionBy(*bucket).orderBy("_key", "_tie")
    ranked = placed.withColumn("rank", start + F.row_number().over(within) - 1)
    if before is not None:
        ranked = ranked.filter(F.col("rank") < before)
    return ranked.select(*[F.col(f"`{c}`") for c in columns], "rank")


def shuffle_rows(
    df: DataFrame, key: str | Sequence[str], seed: int = SEED, partitions: int | None = None, first: Sequence[str] = ()
) -> DataFrame:
    """Rows in seeded random order, the same sequence for any number of partitions.

    The hash is uniform, so its leading digits are the partition: no sampling pass as for a general sort. ``first``
    names columns that are sorted ahead of the hash inside a partition, as a write by these columns needs it.
    """
    partitions = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    leading = F.conv(F.substring("_h", 1, 8), 16, 10).cast("long")
    place = F.shiftright(leading * partitions, 32).cast("int")
    return (
        df.withColumn("_h", order_hash(key, seed))
        .repartitionById(partitions, place)
        .sortWithinPartitions(*first, "_h", *_columns(key))
        .drop("_h")
    )
