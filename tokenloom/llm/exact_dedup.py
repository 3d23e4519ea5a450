"""Exact dedup: rows are grouped by a 128-bit content hash and bytes are compared inside the groups.

A null text counts as empty. Copies are grouped by (hash, text) with a partial aggregation, so a text that fills a third
of the table is folded inside each task before anything moves; this grouping is the comparison of bytes. A hash that
holds more than one text (a collision) is split by the text itself. The answer goes back to the rows by a join on (hash,
salt), where the salt comes from the id: a hot group is spread over ``SALTS`` tasks, and the group table holds one copy for
each salt that occurs.

Defined results: the row with the smallest (or largest) id stays; null ids lose to any other id; of rows that repeat
both id and text exactly one is kept; an empty table gives an empty result; other columns may have any name.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F

from tokenloom.llm.common import materialise, packed, text_or_empty

SALTS = 64


def _unchanged(text: Column) -> Column:
    return text


def _hashed(rows: DataFrame, digest: Callable[[Column], Column]) -> DataFrame:
    salt = F.pmod(F.xxhash64("id"), F.lit(SALTS)).cast("int")
    return rows.withColumn("hash", digest(F.col("text"))).withColumn("salt", salt)


def _folded(keep: str) -> list[Column]:
    if keep not in ("smallest", "largest"):
        raise ValueError("keep must be smallest or largest")
    chosen = F.min("id") if keep == "smallest" else F.max("id")
    return [chosen.alias("keep_id"), F.count(F.lit(1)).alias("group_size"), F.expr("bit_or(shiftleft(1L, salt))").alias("salts")]


def _classes(hashed: DataFrame, keep: str) -> tuple[DataFrame, DataFrame]:
    """Rows with their class key ``key``, and one row per class: key, keep_id, group_size, salts."""
    by_text = hashed.groupBy("hash", "text").agg(*_folded(keep))
    merge = F.min if keep == "smallest" else F.max
    by_hash = by_text.groupBy("hash").agg(
        F.count(F.lit(1)).alias("texts"), merge("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size"),
        F.expr("bit_or(salts)").alias("salts"),
    )
    by_hash = materialise(by_hash, "content-hashes")
    clashes = by_hash.filter("texts > 1").select("hash", F.lit(True).alias("clash"))
    if clashes.isEmpty():
        return hashed.withColumn("key", F.col("hash")), by_hash.withColumnRenamed("hash", "key").drop("texts")
    # two texts under one hash: their classes are keyed by the text
    split = F.when(F.col("clash"), F.concat(F.col("hash"), F.lit(":"), F.col("text"))).otherwise(F.col("hash"))
    keyed = hashed.join(clashes, "hash", "left").withColumn("key", split)
    return keyed, keyed.groupBy("key").agg(*_folded(keep))


def _first_of_repeats() -> Column:
    return F.row_number().over(Window.partitionBy("key", "salt", "id").orderBy("tie")) == 1


def exact_groups(
    docs: DataFrame, id: str = "doc_id", text: str = "text", normalise: Callable[[Column], Column] = _unchanged,
    keep: str = "smallest", digest: Callable[[Column], Column] = F.md5,
) -> DataFrame:
    """One row per input row: ``id, keep_id, group_size, kept, text_sha256`` (of the normalised text)."""
    rows = docs.select(F.col(f"`{id}`").alias("id"), normalise(text_or_empty(text)).alias("text"))
    keyed, classes = _classes(_hashed(rows, digest), keep)
    spread = classes.withColumn("salt", F.explode(F.expr(f"filter(sequence(0, {SALTS - 1}), b -> getbit(salts, b) = 1)")))
    narrow = keyed.select("key", "salt", "id", F.unhex(F.sha2("text", 256)).alias("sha"))
    joined = narrow.join(spread.drop("salts"), ["key", "salt"]).withColumn("tie", F.lit(0))
    kept = F.col("id").eqNullSafe(F.col("keep_id")) & _first_of_repeats()
    return joined.select("id", "keep_id", "group_size", kept.alias("kept"), F.lower(F.hex("sha")).alias("text_sha256"))


def exact_dedup(
    docs: DataFrame, id: str = "doc_id", text: str = "text", normalise: Callable[[Column], Column] = _unchanged,
    keep: str = "smallest", digest: Callable[[Column], Column] = F.md5,
) -> DataFrame:
    """The rows that stay, with all their columns: one per distinct normalised text."""
    whole = packed(docs, id=F.col(f"`{id}`"), text=normalise(text_or_empty(text)))
    keyed, classes = _classes(_hashed(whole.drop("row"), digest), keep)
    keepers = classes.select("key", F.col("keep_id").alias("wanted"))
    clashing = "clash" in keyed.columns
    rows = _hashed(whole, digest)
    if clashing:
        clashes = keyed.filter("clash").select("hash", "clash").distinct()
        split = F.when(F.col("clash"), F.concat(F.col("hash"), F.lit(":"), F.col("text"))).otherwise(F.col("hash"))
        rows = rows.join(clashes, "hash", "left").withColumn("key", split)
    else:
        rows = rows.withColumn("key", F.col("hash"))
    # only the row that stays finds its class, so the join is even whatever the groups look like
    found = rows.drop("text", "hash").join(
        keepers.withColumnRenamed("key", "class"), (F.col("key") == F.col("class")) & F.col("id").eqNullSafe(F.col("wanted"))
    )
    found = found.withColumn("tie", F.xxhash64(F.to_json("row"))).withColumn("first", _first_of_repeats())
    return found.filter("first").select("row.*")
