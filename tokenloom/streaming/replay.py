"""Training rows as a stream in training order, over as many epochs as the step table holds.

The stream itself is a clock: a source whose offset is a step and the number of its micro batch, and whose rows are step numbers, a few per
micro batch. What belongs to these steps is then read from the step table, which opens the files of the steps alone. So progress, restarts
and exactly one use of each step are the engine's, while rows never pass through the driver.

A trigger of the engine costs about a second however little it does. Where rows are only stored, a trigger therefore takes many micro
batches at once, each with a folder of its own, so that a long table needs a number of triggers and not a trigger per few steps.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, Row, SparkSession, functions as F
from pyspark.sql.datasource import DataSource, SimpleDataSourceStreamReader
from pyspark.sql.streaming import StreamingQuery

from tokenloom.session import ship_package
from tokenloom.sinks.steps import count_steps, read_steps
from tokenloom.streaming import write_batch

FORMAT = "tokenloom-steps"
BATCHES_PER_TRIGGER = 512


class _Clock(SimpleDataSourceStreamReader):
    def __init__(self, first: int, last: int, per_batch: int, batches: int):
        self.first, self.last, self.per_batch, self.batches = first, last, per_batch, batches

    def initialOffset(self) -> dict:
        return {"step": self.first, "batch": 0}

    def read(self, start: dict) -> tuple[Iterator[tuple], dict]:
        step = max(min(start["step"] + self.per_batch * self.batches, self.last), start["step"])
        end = {"step": step, "batch": self._batch(start, step + self.per_batch - 1)}
        return self.readBetweenOffsets(start, end), end

    def readBetweenOffsets(self, start: dict, end: dict) -> Iterator[tuple]:
        return iter([(step, self._batch(start, step)) for step in range(start["step"], end["step"])])

    def _batch(self, start: dict, step: int) -> int:
        """Micro batch of a step; a progress stored without such numbers has taken ``per_batch`` steps to each."""
        before = start["batch"] if "batch" in start else -(-(start["step"] - self.first) // self.per_batch)
        return before + (step - start["step"]) // self.per_batch


class StepClock(DataSource):
    """Numbers of steps from option ``first`` to before ``last``, ``perBatch`` of them in a micro batch and ``batches`` of these in a trigger."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return "step long, batch long"

    def simpleStreamReader(self, schema) -> _Clock:
        first, last, per_batch, batches = (int(self.options.get(o, d)) for o, d in (("first", 0), ("last", 0), ("perBatch", 1), ("batches", 1)))
        return _Clock(first, last, per_batch, batches)


def replay_steps(
    spark: SparkSession, path: str, checkpoint: str, use: Callable[[DataFrame, int], None], first: int = 0, last: int | None = None,
    steps_per_batch: int = 1, process: int = 0, processes: int = 1,
) -> StreamingQuery:
    """Call ``use(rows, batch)`` with the rows of the next steps until all have been used; a later call goes on where it stopped.

    A micro batch that fails is given again with the same number and rows.
    """

    def next_steps(span: Row, number: int) -> None:
        use(read_steps(spark, path, span.first, span.last + 1, process, processes), number)

    return _run(spark, path, checkpoint, next_steps, first, last, steps_per_batch, 1)


def _run(
    spark: SparkSession, path: str, checkpoint: str, use: Callable[[Row, int], None], first: int, last: int | None, steps_per_batch: int, batches: int
) -> StreamingQuery:
    """Call ``use`` with the ``first`` and ``last`` step of every trigger and the number of its first micro ``batch``."""
    ship_package(spark)
    spark.dataSource.register(StepClock)
    until = count_steps(spark, path) if last is None else last
    options = {"first": first, "last": until, "perBatch": steps_per_batch, "batches": batches}
    clock = spark.readStream.format(FORMAT).options(**options).load()

    def next_steps(ticks: DataFrame, number: int) -> None:
        # a row per step of the trigger
        span = ticks.agg(F.min("step").alias("first"), F.max("step").alias("last"), F.min("batch").alias("batch")).first()
        if span.first is not None:
            use(span, number)

    query = clock.writeStream.foreachBatch(next_steps).option("checkpointLocation", checkpoint).start()
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    return query


def store_steps(
    spark: SparkSession, path: str, out: str, checkpoint: str, first: int = 0, last: int | None = None, steps_per_batch: int = 1,
    process: int = 0, processes: int = 1, batches_per_trigger: int = BATCHES_PER_TRIGGER,
) -> StreamingQuery:
    """The replayed rows below ``out``, a folder ``batch=...`` per micro batch, in rank order within a file.

    A trigger writes so many micro batches in one job. One that is done again after a failure takes the place of what it left.
    """

    def store(span: Row, number: int) -> None:
        rows = read_steps(spark, path, span.first, span.last + 1, process, processes)
        if processes > 1 and rows.isEmpty():
            # nothing for this process; a folder without rows still tells the columns
            return write_batch(rows, out, span.batch)
        batch = F.expr(f"{span.batch} + (step - {span.first}) div {steps_per_batch}")
        placed = rows.withColumn("batch", batch).sortWithinPartitions("batch", "rank")
        placed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(out)

    return _run(spark, path, checkpoint, store, first, last, steps_per_batch, batches_per_trigger)
