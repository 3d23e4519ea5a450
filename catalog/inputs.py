"""Test tables in the shapes that the library reads."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tokenloom.sources import spread

SEGMENT = 256


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def spread_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents for work that is heavy per row; the test files are single row groups."""
    return spread(documents(spark, sf_dir), "doc_id")


def instruct_source(spark: SparkSession, sf_dir: str, answered: bool = True) -> DataFrame:
    """User turns as instruct rows: system text of the conversation, user text, directly following answer.

    The answer is found by an equi join on (conversation, turn). System texts are joined per conversation and block of
    turns, one copy per block, so a conversation that holds a large part of all turns is spread over its blocks.
    """
    turns = table(spark, sf_dir, "conversations")
    user = turns.filter("role = 'user'").select(
        "conv_id", "turn", F.floor(F.col("turn") / SEGMENT).alias("block"), F.col("text").alias("input")
    )
    answer = turns.filter("role = 'assistant'").select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("output")
    )
    last = turns.groupBy("conv_id").agg(F.max("turn").alias("last"))
    system = (
        turns.filter("role = 'system' and turn = 0")
        .select("conv_id", F.col("text").alias("instruct"))
        .join(last, "conv_id")
        .withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.floor(F.col("last") / SEGMENT))))
        .drop("last")
    )
    rows = user.join(answer, ["conv_id", "turn"], "inner" if answered else "left")
    return rows.join(system, ["conv_id", "block"], "left").select("conv_id", "turn", "instruct", "input", "output")


def alpaca_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows without a system text, under the column names of the first instruct source."""
    rows = instruct_source(spark, sf_dir).filter("instruct is null")
    return rows.withColumnRenamed("instruct", "instruction")


def orca_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows with a system text, under the column names of the second instruct source."""
    rows = instruct_source(spark, sf_dir).filter("instruct is not null")
    return rows.select(
        F.concat_ws(".", "conv_id", "turn").alias("id"), "conv_id", "turn",
        F.col("instruct").alias("system_prompt"), F.col("input").alias("question"), F.col("output").alias("response"),
    )
