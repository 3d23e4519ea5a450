"""Mixing sources to target weights by capped water-filling.

Every source wants a share of the budget by its weight, but gives at most ``max_epochs`` times its size. With the sources in
order of capacity per unit of weight, those that fill up form a prefix, and prefix sums of capacity and weight find
the water level that repeated clamping and resharing would end at. A source with target ``t`` and size ``s`` is taken
``floor(t / s)`` whole times; the rest is a seeded sample: documents in the order of ``md5(seed:id)`` until the rest is
filled, to the nearest document.

That order is counted in 4,096 hash buckets by source; only the one bucket in which a source's rest ends is sorted. Rows
are narrow, and the small plan table is joined with a salt, so a source with a third of all rows stays spread out.

Defined results: a null text has size 0; a null source is a source of its own, last in order; a null, zero or negative
weight takes nothing; rows that agree in id are taken alike; an empty table gives an empty result; other columns may have any name.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tokenloom.constants import SEED
from tokenloom.llm.common import materialise, packed, text_or_empty

WORD = r"[^\x20\x09-\x0D]+"
DIGITS = 3
SALTS = 64


def word_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def cyclic_weights(sources: DataFrame, cycle: Sequence[float], source: str = "source") -> DataFrame:
    """Weights that repeat along the sources by code point, null last; ``sources`` has one row per source."""
    place = F.row_number().over(Window.orderBy(F.col(source).asc_nulls_last())) - 1
    weight = F.get(F.array(*[F.lit(float(w)) for w in cycle]), F.pmod(place, F.lit(len(cycle))))
    return sources.select(source, weight.alias("weight"))


def water_fill(sizes: DataFrame, weights: DataFrame, max_epochs: int, budget: float = 1.0) -> DataFrame:
    """``source, source_size, target`` from ``source, source_size`` and ``source, weight``; one row per source.

    ``budget`` is a multiple of all sizes. The unpartitioned windows hold one row per source.
    """
    w = F.greatest(F.coalesce(F.col("weight").cast("double"), F.lit(0.0)), F.lit(0.0))
    named = weights.select(F.col("source").alias("named"), "weight")
    rows = sizes.join(named, F.col("source").eqNullSafe(F.col("named")), "left").select("source", "source_size", w.alias("w"))
    rows = rows.withColumn("cap", F.when(F.col("w") > 0, F.col("source_size") * F.lit(float(max_epochs))).otherwise(0.0))
    all_rows = Window.partitionBy()
    level = Window.orderBy(F.expr("cap / nullif(w, 0)").asc_nulls_last(), F.col("source").asc_nulls_last())
    before = level.rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumns({
        "total": F.sum("source_size").over(all_rows) * F.lit(float(budget)), "all_w": F.sum("w").over(all_rows),
        "cap_before": F.coalesce(F.sum("cap").over(before), F.lit(0.0)), "w_before": F.coalesce(F.sum("w").over(before), F.lit(0.0)),
    })
    full = (F.col("total") - F.col("cap_before")) * F.col("w") >= F.col("cap") * (F.col("all_w") - F.col("w_before"))
    rows = rows.withColumn("full", full & (F.col("w") > 0)).withColumns({
        "left_over": F.col("total") - F.sum(F.when(F.col("full"), F.col("cap")).otherwise(0.0)).over(all_rows),
        "open_w": F.col("all_w") - F.sum(F.when(F.col("full"), F.col("w")).otherwise(0.0)).over(all_rows),
    })
    shared = F.expr("w * left_over / nullif(open_w, 0)")
    target = F.when(F.col("full"), F.col("cap")).when(F.col("w") > 0, shared).otherwise(0.0)
    return rows.select("source", "source_size", target.alias("target"))


def mixing_plan(sized: DataFrame, targets: DataFrame) -> DataFrame:
    """Per source: target, whole repetitions, and the last order key that is taken once more.

    ``sized`` has rows ``source, size, order``.
    """
    whole = F.coalesce(F.floor(F.expr("target / nullif(source_size, 0)")), F.lit(0))
    rest = F.col("target") - F.col("whole") * F.col("source_size")
    wanted = targets.withColumn("whole", whole).withColumn("rest", rest)
    bucket = F.substring("order", 1, DIGITS)
    sums = sized.groupBy("source", bucket.alias("bucket")).agg(F.sum("size").alias("words"))
    upto = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sums = sums.withColumn("start", F.sum("words").over(upto) - F.col("words")).withColumnRenamed("source", "of")
    edge = wanted.join(sums, F.col("source").eqNullSafe(F.col("of")))
    edge = edge.filter("start < rest and rest <= start + words").select(F.col("of"), F.col("bucket").alias("edge"), "start", "rest")
    inside = sized.join(edge, F.col("source").eqNullSafe(F.col("of")) & (bucket == F.col("edge")))
    run = Window.partitionBy("source").orderBy("order", "size").rowsBetween(Window.unboundedPreceding, -1)
    reached = F.col("start") + F.coalesce(F.sum("size").over(run), F.lit(0)) + F.col("size") / 2 <= F.col("rest")
    last = inside.withColumn("reached", reached).groupBy("of", "edge").agg(F.max(F.when(F.col("reached"), F.col("order"))).alias("last"))
    # below the edge bucket all rows are taken once more
    last = last.select("of", F.coalesce("last", "edge").alias("last"))
    plan = wanted.join(last, F.col("source").eqNullSafe(F.col("of")), "left")
    return plan.select("source", "source_size", "target", "whole", "last")


def _with_repeats(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """Rows with ``source, order`` joined with their source's plan, and ``repeats``."""
    copies = plan.withColumnRenamed("source", "of").withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salt = F.pmod(F.xxhash64("order"), F.lit(SALTS)).cast("int")
    match = F.col("source").eqNullSafe(F.col("of")) & (F.col("spread") == F.col("salt"))
    joined = rows.withColumn("spread", salt).join(copies, match).drop("of", "salt", "spread")
    once_more = F.coalesce((F.col("order") <= F.col("last")).cast("int"), F.lit(0))
    return joined.withColumn("repeats", (F.col("whole") + once_more).cast("int"))


def order_key(id: str, seed: int) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(f"`{id}`").cast("string"), F.lit(""))))


def plan_mix(
    docs: DataFrame, weights: DataFrame | Sequence[float], max_epochs: int = 3, budget: float = 1.0, id: str = "doc_id",
    source: str = "source", size: Column | None = None, seed: int = SEED,
) -> tuple[DataFrame, DataFrame]:
    """Narrow rows ``id, source, size, order``, written once, and the plan per source.

    ``weights`` is a frame ``source, weight`` or a cycle along the sorted sources; ``size`` defaults to the words of ``text``.
    """
    size = word_count(text_or_empty("text")) if size is None else size
    sized = docs.select(
        F.col(f"`{id}`").alias("id"), F.col(f"`{source}`").cast("string").alias("source"), size.alias("size"),
        order_key(id, seed).alias("order"),
    )
    sized = materialise(sized, "sizes")
    sizes = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    if not isinstance(weights, DataFrame):
        weights = cyclic_weights(sizes, weights)
    return sized, materialise(mixing_plan(sized, water_fill(sizes, weights, max_epochs, budget)), "mix-plan")


def mix_counts(docs: DataFrame, weights: DataFrame | Sequence[float], **options) -> DataFrame:
    """One row per document: ``id, source, size, source_size, target, repeats``."""
    sized, plan = plan_mix(docs, weights, **options)
    return _with_repeats(sized, plan).select("id", "source", "size", "source_size", "target", "repeats")


def mix(docs: DataFrame, weights: DataFrame | Sequence[float], **options) -> DataFrame:
    """The mixed rows: every document as often as it is taken, with the columns of the input."""
    _, plan = plan_mix(docs, weights, **options)
    id, seed = options.get("id", "doc_id"), options.get("seed", SEED)
    source = F.col(f"`{options.get('source', 'source')}`").cast("string")
    taken = _with_repeats(packed(docs, source=source, order=order_key(id, seed)), plan).filter("repeats > 0")
    return taken.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("repeats")))).select("row.*")
