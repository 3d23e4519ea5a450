"""Training rows as Structured Streaming jobs.

The row functions are stateless, so a stream needs neither watermark nor state store: files in, rows out, progress in
the checkpoint. Each input row is used once, also across restarts.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from tokenloom.constants import MAX_SEQ_LEN
from tokenloom.functions.codec import Encoder
from tokenloom.operators.columns import instruct_reject, pretrain_reject
from tokenloom.operators.training_rows import instruct_rows, pretrain_rows
from tokenloom.sinks import as_int64
from tokenloom.sources import CORRUPT, INSTRUCT_SCHEMA, PRETRAIN_SCHEMA, stream_jsonl


def run_available(rows: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Write all rows available now as parquet and stop."""
    query = (
        rows.writeStream.format("parquet")
        .option("path", out)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def write_batch(rows: DataFrame, out: str, number: int) -> None:
    """One micro batch as a folder of its own. A batch that is done again after a failure takes the place of what it left."""
    rows.write.mode("overwrite").parquet(f"{out.rstrip('/')}/batch={number}")


def _stream(
    spark: SparkSession, source: str, schema: str, keep: str, files_per_trigger: int | None, reason: Column,
    transform: Callable[[DataFrame], DataFrame], out: str, checkpoint: str, rejects: str | None,
) -> StreamingQuery:
    """Usable rows to ``out``; broken lines and rows that no training row can be made of to ``rejects``, if it is named.

    With two outputs each micro batch is read and checked once, kept while both are written, and has a folder ``batch=...`` in both:
    a restart writes the same folders again, so rows are neither lost nor doubled in either.
    """
    rows = stream_jsonl(spark, source, f"{keep}, {schema}" if keep else schema, files_per_trigger, keep_corrupt=True)
    marked = rows.withColumn("reject_reason", F.when(F.col(CORRUPT).isNotNull(), "broken_line").otherwise(reason))
    good, bad = F.col("reject_reason").isNull(), F.col("reject_reason").isNotNull()

    def usable(checked: DataFrame) -> DataFrame:
        return as_int64(transform(checked.filter(good).drop(CORRUPT, "reject_reason")))

    if rejects is None:
        return run_available(usable(marked), out, checkpoint)

    def write_both(batch: DataFrame, number: int) -> None:
        checked = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            write_batch(usable(checked), out, number)
            write_batch(checked.filter(bad), rejects, number)
        finally:
            checked.unpersist()

    query = marked.writeStream.foreachBatch(write_both).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def stream_pretrain(
    spark: SparkSession, source: str, out: str, checkpoint: str, encoder: Encoder, length: int = MAX_SEQ_LEN,
    compat: bool = False, keep_schema: str = "", keep: tuple = (), files_per_trigger: int | None = None,
    rejects: str | None = None,
) -> StreamingQuery:
    """JSON lines with ``text`` to pretraining rows."""
    return _stream(
        spark, source, PRETRAIN_SCHEMA, keep_schema, files_per_trigger, pretrain_reject(F.col("text")),
        lambda df: pretrain_rows(df, encoder, length, compat=compat, keep=keep), out, checkpoint, rejects,
    )


def stream_instruct(
    spark: SparkSession, source: str, out: str, checkpoint: str, encoder: Encoder, length: int = MAX_SEQ_LEN,
    compat: bool = False, label_pad: int | None = None, keep_schema: str = "", keep: tuple = (),
    files_per_trigger: int | None = None, rejects: str | None = None,
) -> StreamingQuery:
    """JSON lines with ``instruct``, ``input`` and ``output`` to instruct rows."""
    return _stream(
        spark, source, INSTRUCT_SCHEMA, keep_schema, files_per_trigger,
        instruct_reject(F.col("instruct"), F.col("input"), F.col("output")),
        lambda df: instruct_rows(df, encoder, length, compat, label_pad, keep), out, checkpoint, rejects,
    )
