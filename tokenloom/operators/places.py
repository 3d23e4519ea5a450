"""Order of rows by their place in the files, without a key column, a sort or an exchange of rows.

The rows of one split of a file are read one after the other, so a row's place is its file, the split's first byte and a number
that rises within the split. Splits are counted by one narrow aggregation; what comes of it is a table with a row per split, which the
driver of any scan holds as well, so prefix sums over it are small however large the files are. A position in the whole then lies
in one known split. Heads and chunks compare each row's place with a few such places; positions of all rows add the start of their split.

Files follow each other by path, as the writers of numbered part files name them. The frame must come from files (a reader, with filters
or added columns at most), since it is read twice and must give the same rows in the same order both times. Text, JSON and
Parquet files behave alike.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from tokenloom.operators.ranking import chunk_starts, head_rows

_PLACE = "_place"
_NARROW = (T.NumericType, T.BooleanType, T.DateType, T.TimestampType)


def with_place(df: DataFrame) -> DataFrame:
    """Column ``_place``, a struct whose order is the order of the files; unique per row."""
    place = F.struct(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("at"),
    )
    return df.select("*", place.alias(_PLACE))


def splits(df: DataFrame) -> DataFrame:
    """A row per split that has rows: ``file, block, first, rows, start, total``; ``start`` counts the rows before it."""
    placed = with_place(df)
    # some readers count lines without looking at them when no column is asked for, and a blank line is no row
    narrow = [f.name for f in df.schema if isinstance(f.dataType, _NARROW)] or df.columns
    one = F.when(F.xxhash64(F.col(f"`{narrow[0]}`")) == 0, 1).otherwise(1)
    counted = placed.groupBy(f"{_PLACE}.file", f"{_PLACE}.block").agg(F.min(f"{_PLACE}.at").alias("first"), F.sum(one).alias("rows"))
    whole = Window.orderBy("file", "block")
    return counted.select(
        "*", (F.sum("rows").over(whole.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("rows")).alias("start"),
        F.sum("rows").over(whole.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("total"),
    )


def _with_cuts(df: DataFrame, positions: Callable[[Column], list[Column]]) -> DataFrame:
    """Rows with their place and ``_cut0``, ``_cut1``, ...: the places of the rows at some positions, null beyond the end, and ``_total``."""
    parts = splits(df)
    asked = positions(F.col("total"))
    wanted = parts.withColumn("slots", F.array(*[p.cast("long") for p in asked])).select("*", F.posexplode("slots").alias("slot", "position"))
    inside = (F.col("position") >= F.col("start")) & (F.col("position") < F.col("start") + F.col("rows"))
    place = F.when(inside, F.struct("file", "block", (F.col("first") + F.col("position") - F.col("start")).alias("at")))
    cuts = [F.max(F.when(F.col("slot") == i, place)).alias(f"_cut{i}") for i in range(len(asked))]
    found = wanted.agg(*cuts, F.max("total").alias("_total"))
    marked = with_place(df).withColumn("_found", found.select(F.struct("*")).scalar())
    return marked.select(*[F.col(f"`{c}`") for c in df.columns], _PLACE, "_found.*")


def _before(slot: int) -> Column:
    return F.coalesce(F.col(_PLACE) < F.col(f"_cut{slot}"), F.lit(True))


def head_by_place(df: DataFrame, percent: float) -> DataFrame:
    """First ``percent`` of the rows in the order of the files, rounded half to even."""
    return _with_cuts(df, lambda total: [head_rows(total, percent)]).filter(_before(0)).select(*df.columns)


def chunks_by_place(df: DataFrame, chunks: int, compat: bool = False, percent: float = 100) -> DataFrame:
    """Column ``chunk``: contiguous chunks of the first ``percent`` in the order of the files, the first ones one row longer.

    With ``compat`` every chunk starts at the first row, so a row belongs to several chunks or to none.
    """
    if compat:
        def ends(total: Column) -> list[Column]:
            whole = F.floor(head_rows(total, percent) / chunks)
            return [whole, whole + 1]

        rest = (head_rows(F.col("_total"), percent) % chunks).cast("int")
        upto = F.when(_before(0), chunks - 1).when(_before(1), rest - 1).otherwise(-1)
        kept = _with_cuts(df, ends).withColumn("_upto", upto).filter("_upto >= 0")
        return kept.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("_upto")))).select(*df.columns, "chunk")
    cut = _with_cuts(df, lambda total: chunk_starts(total, chunks, percent)).filter(_before(0))
    passed = [F.when(_before(i), 0).otherwise(1) for i in range(1, chunks)]
    return cut.withColumn("chunk", sum(passed, F.lit(0))).select(*df.columns, "chunk")


def with_position(df: DataFrame, name: str = "position") -> DataFrame:
    """Column ``position``: how many rows come before a row in the order of the files.

    Rows meet the table of splits in place; Spark broadcasts that table unless it is beyond its limit.
    """
    parts = splits(df).select(F.col("file").alias("_file"), F.col("block").alias("_block"), (F.col("start") - F.col("first")).alias("_ahead"))
    on = (F.col(f"{_PLACE}.file") == F.col("_file")) & (F.col(f"{_PLACE}.block") == F.col("_block"))
    found = with_place(df).join(parts, on)
    return found.select(*[F.col(f"`{c}`") for c in df.columns], (F.col(f"{_PLACE}.at") + F.col("_ahead")).alias(name))
