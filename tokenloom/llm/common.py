"""Helpers shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tokenloom.session import shared_path


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write a frame below the shared folder and read it back: cuts lineage, and lost executors cost no recomputation."""
    path = shared_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def packed(df: DataFrame, **columns: Column) -> DataFrame:
    """All columns as one struct ``row`` beside new ones, so that no name of the input can clash; undo with ``row.*``."""
    return df.select(F.struct("*").alias("row"), *[c.alias(name) for name, c in columns.items()])


def text_or_empty(text: str) -> Column:
    return F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
