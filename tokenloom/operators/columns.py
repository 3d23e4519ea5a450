"""Row-local projections, the strict union and the split into usable and rejected rows."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

ALPACA_NAMES = {"instruction": "instruct"}
# Rows that a user function gets at a time; what it makes of them stands beside the rows.
FUNCTION_ROWS = 1000
ORCA_NAMES = {"system_prompt": "instruct", "question": "input", "response": "output"}


def drop_columns(df: DataFrame, *names: str) -> DataFrame:
    """Drop columns; a missing one is an error."""
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"no such column: {missing}")
    return df.drop(*names)


def rename_columns(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"no such column: {missing}")
    return df.withColumnsRenamed(dict(names))


def title_text(title: Column, text: Column) -> Column:
    """Title and text with a space between; a null title counts as empty."""
    return F.concat(F.coalesce(title, F.lit("")), F.lit(" "), text)


def wrap_text(text: Column) -> Column:
    return F.concat(F.lit("<s>"), text, F.lit("</s>"))


def union_sources(*frames: DataFrame) -> DataFrame:
    """All rows of all frames, columns matched by name; differing columns are an error."""
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame)
    return result


def pretrain_reject(text: Column) -> Column:
    return F.when(text.isNull(), "no_text")


def instruct_reject(instruct: Column, input_: Column, output: Column) -> Column:
    """Why an instruct row is unusable, null for a good one."""
    empty = [c.isNull() | (c == "") for c in (instruct, input_)]
    return F.when(empty[0] & empty[1], "no_prompt").when(output.isNull(), "no_output")


def split_rejects(df: DataFrame, reason: Column) -> tuple[DataFrame, DataFrame]:
    """Good rows without the reason column, and rejected rows with it."""
    marked = df.withColumn("reject_reason", reason)
    return (
        marked.filter(F.col("reject_reason").isNull()).drop("reject_reason"),
        marked.filter(F.col("reject_reason").isNotNull()),
    )


def map_batches(
    df: DataFrame, function: Callable[[pd.DataFrame], Mapping[str, Sequence]], schema: str, remove: Sequence[str] = ()
) -> DataFrame:
    """New columns from a user function on batches of rows, without the ``remove`` columns.

    For functions that no Spark expression can replace. The function gets a pandas batch of at most ``FUNCTION_ROWS`` rows and returns the columns that
    ``schema`` declares, one value per row; a column of the same name is replaced.
    """
    made = T.StructType.fromDDL(schema)
    kept = [f for f in df.schema.fields if f.name not in {*remove, *made.names}]
    kept_names, made_names = [f.name for f in kept], made.names

    def batches(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for first in range(0, len(frame), FUNCTION_ROWS):
                part = frame.iloc[first : first + FUNCTION_ROWS].reset_index(drop=True)
                result = function(part)
                yield part[kept_names].assign(**{name: list(result[name]) for name in made_names})

    return df.mapInPandas(batches, T.StructType(kept + made.fields))
