"""Document fingerprints: the ``k`` smallest hashes of a text's word shingles.

A sketch is a sorted array of at most ``k`` 64-bit hashes. Sketches merge (the smallest ``k`` of the union are the sketch of
the union), and two of them estimate resemblance, containment and the number of distinct shingles. A sketch with
fewer than ``k`` hashes holds all shingles, so estimates from such sketches are exact.

Words are runs of characters other than space and U+0009 to U+000D. A text of fewer words than a shingle has one shingle, all its
words; a text without words (null, empty, only spaces) has the empty sketch. Two empty sketches resemble each other fully.
Repeated shingles count once, equal texts have equal sketches.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tokenloom.llm.common import materialise, text_or_empty

K = 128
WORDS = 5
SPACES = r"[\x20\x09-\x0D]+"


def with_sketch(df: DataFrame, text: str, out: str, k: int = K, words: int = WORDS) -> DataFrame:
    """The frame with the sketch of a text column; each step is a column of its own, so that arrays are made once."""
    made, inner = f"_{out}_words", f"_{out}_shingles"
    parts = F.filter(F.split(text_or_empty(text), SPACES), lambda w: w != "")
    df = df.withColumn(made, F.transform(parts, lambda w: F.xxhash64(w)))
    hashes = F.col(made)
    last = F.greatest(F.size(hashes) - words, F.lit(0))
    # beyond the end get() is null, which the hash passes over
    shingle = F.transform(F.sequence(F.lit(0), last), lambda i: F.xxhash64(*[F.get(hashes, i + j) for j in range(words)]))
    df = df.withColumn(inner, F.when(F.size(hashes) > 0, shingle).otherwise(F.array().cast("array<bigint>")))
    return df.withColumn(out, F.slice(F.sort_array(F.array_distinct(inner)), 1, k)).drop(made, inner)


def union_sketch(a: Column, b: Column, k: int = K) -> Column:
    return F.slice(F.sort_array(F.array_union(a, b)), 1, k)


def merge_sketches(df: DataFrame, by: Sequence[str], sketch: str, k: int = K) -> DataFrame:
    """One sketch per group. Equal hashes are folded in each task, and each task passes on ``k`` per group at most."""
    hashes = df.select(*by, F.explode(sketch).alias("_hash")).distinct()
    smallest = hashes.withColumn("_n", F.row_number().over(Window.partitionBy(*by).orderBy("_hash"))).filter(F.col("_n") <= k)
    return smallest.groupBy(*by).agg(F.sort_array(F.collect_list("_hash")).alias(sketch))


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """Estimated Jaccard similarity, 0 to 1."""
    union = union_sketch(a, b, k)
    shared = F.size(F.array_intersect(union, F.array_intersect(a, b)))
    return F.when(F.size(union) == 0, 1.0).otherwise(shared / F.greatest(F.size(union), F.lit(1)))


def distinct_shingles(sketch: Column, k: int = K) -> Column:
    """Estimated number of distinct shingles; exact below ``k``."""
    share = (F.get(sketch, F.lit(k - 1)).cast("double") + 2.0**63) / 2.0**64
    return F.when(F.size(sketch) < k, F.size(sketch).cast("double")).otherwise((k - 1) / F.greatest(share, F.lit(2.0**-64)))


def containment(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of the shingles of ``a`` that ``b`` holds; 1 for an empty ``a``."""
    shared = distinct_shingles(union_sketch(a, b, k), k) * resemblance(a, b, k)
    share = shared / F.greatest(distinct_shingles(a, k), F.lit(1.0))
    return F.when(F.size(a) == 0, 1.0).otherwise(F.least(share, F.lit(1.0)))


def as_text(sketch: Column) -> Column:
    return F.array_join(sketch.cast("array<string>"), ",")


def neighbours(docs: DataFrame, id: str = "doc_id", text: str = "text", row: str | None = None) -> DataFrame:
    """``id, next_id, prev_id, prev_chars``: the circle of ids in ascending order, without moving texts.

    Null ids come last. Where ids repeat or are null, ``row`` names a number that is a row's own; it orders such rows, and
    ``row, next_row, prev_row`` come with the result. Keys are range partitioned with their lengths; the ends of the partitions
    meet in a table of one row per partition.
    """
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    own = F.col(f"`{row}`") if row else F.lit(0)
    key = F.struct(F.col(f"`{id}`").isNull().alias("none"), F.col(f"`{id}`").alias("id"), own.cast("long").alias("row"))
    narrow = docs.select(key.alias("key"), F.length(text_or_empty(text)).alias("chars"))
    placed = materialise(narrow.repartitionByRange(parts, "key").withColumn("part", F.spark_partition_id()), "ids")
    inside = Window.partitionBy("part").orderBy("key")
    ends = placed.groupBy("part").agg(
        F.min("key").alias("low"), F.max("key").alias("high"), F.max_by("chars", "key").alias("high_chars")
    )
    # one row per partition
    line, circle = Window.orderBy("part"), Window.partitionBy()
    ends = ends.select(
        F.col("part").alias("at"),
        F.coalesce(F.lead("low").over(line), F.min("low").over(circle)).alias("after"),
        F.coalesce(F.lag("high").over(line), F.max("high").over(circle)).alias("before"),
        F.coalesce(F.lag("high_chars").over(line), F.max_by("high_chars", "part").over(circle)).alias("before_chars"),
    )
    rows = placed.withColumns({
        "next": F.lead("key").over(inside), "prev": F.lag("key").over(inside), "prev_chars": F.lag("chars").over(inside),
    })
    joined = rows.join(F.broadcast(ends), F.col("part") == F.col("at"))
    found = joined.select(
        "key", F.coalesce("next", "after").alias("next"), F.coalesce("prev", "before").alias("prev"),
        F.coalesce("prev_chars", "before_chars").alias("prev_chars"),
    )
    sides = {"id": "key", "next_id": "next", "prev_id": "prev"}
    columns = [F.col(f"{side}.id").alias(name) for name, side in sides.items()]
    if row:
        columns += [F.col(f"{side}.row").alias(name.replace("id", "row")) for name, side in sides.items()]
    return found.select(*columns, "prev_chars")
