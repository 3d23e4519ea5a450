"""Grouping of token rows into micro batches and optimizer steps."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from tokenloom.constants import ACCUMULATION, BATCH_ROWS, SEED
from tokenloom.operators import places
from tokenloom.operators.permutation import Permutation
from tokenloom.operators.ranking import RANK_DIGITS, seeded_order, with_rank


def assign_batches(
    df: DataFrame,
    key: str | Sequence[str],
    seed: int = SEED,
    batch_rows: int = BATCH_ROWS,
    accumulation: int = ACCUMULATION,
    max_steps: int | None = None,
    digits: int = RANK_DIGITS,
) -> DataFrame:
    """Columns ``rank``, ``micro_batch`` and ``step`` in seeded order; rows at or after ``max_steps`` are not used.

    A task sorts one of ``16 ** digits`` buckets at a time; 5 or 6 digits suit tables beyond some terabytes.
    """
    per_step = batch_rows * accumulation
    ranked = with_rank(df, seeded_order(key, seed, digits), None if max_steps is None else max_steps * per_step)
    return ranked.withColumns(
        {"micro_batch": F.floor(F.col("rank") / batch_rows), "step": F.floor(F.col("rank") / per_step)}
    )


def assign_batches_by_place(
    df: DataFrame, seed: int = SEED, batch_rows: int = BATCH_ROWS, accumulation: int = ACCUMULATION, max_steps: int | None = None, epochs: int = 1,
    total: int | None = None,
) -> DataFrame:
    """The same columns without a key, a sort or an exchange: the rank is a permutation of the row's position in the files.

    ``df`` comes straight from files. Its rows are counted by a job, unless the caller knows their ``total``. Every epoch has an order of its own and follows the one before.
    """
    if total is None:
        total = places.splits(df).agg(F.coalesce(F.max("total"), F.lit(0)).alias("n")).first().n
    position, per_step = F.col("_position"), batch_rows * accumulation
    ranks = [Permutation(total, seed, epoch=e).rank_column(position) + F.lit(e * total).cast("long") for e in range(epochs)]
    rank = ranks[0] if epochs == 1 else F.explode(F.array(*ranks))
    ranked = places.with_position(df, "_position").select(*[F.col(f"`{c}`") for c in df.columns], rank.alias("rank"))
    if max_steps is not None:
        ranked = ranked.filter(F.col("rank") < max_steps * per_step)
    return ranked.withColumns({"micro_batch": F.floor(F.col("rank") / batch_rows), "step": F.floor(F.col("rank") / per_step)})


def collect_batches(df: DataFrame, *columns: str) -> DataFrame:
    """One row per micro batch with its rows in order; a group never exceeds the batch size."""
    rows = F.sort_array(F.collect_list(F.struct("rank", *columns)))
    return df.groupBy("step", "micro_batch").agg(rows.alias("rows"))
