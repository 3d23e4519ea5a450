"""Training rows addressed by optimizer step.

Rows are stored by rank, a fixed number of steps to a file, and the folder name says which steps. A reader that asks for some steps
opens the files of those steps alone, whatever the size of the table, so a run that stopped goes on without reading what it has
used, and each of several training processes reads its own micro batches. The number of rows of every file is checked against its
steps before the table is published, so a step is never short.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tokenloom.constants import ACCUMULATION, BATCH_ROWS
from tokenloom.sinks import manifest

STEPS_PER_FILE = 64
# One task per file; more files than this many are dealt over as many tasks.
MOST_TASKS = 100_000
PLACES = ("step", "micro_batch", "span")


def write_steps(
    rows: DataFrame, path: str, total: int, batch_rows: int = BATCH_ROWS, accumulation: int = ACCUMULATION,
    steps_per_file: int = STEPS_PER_FILE, make: Callable[[DataFrame], DataFrame] | None = None,
) -> int:
    """Store rows that have a ``rank`` from 0 to ``total - 1``, each once; returns the number of steps, the last one perhaps short.

    Rows move once, straight to the task of their file, and are sorted there. ``make`` turns them into what is stored in that task, so that
    a task holds the made rows of its file alone; it keeps ``rank`` and the columns named ``PLACES``. A table stored before is replaced as a whole.
    """
    spark = rows.sparkSession
    version, _ = manifest.current(spark, path)
    per_step, per_file = batch_rows * accumulation, batch_rows * accumulation * steps_per_file
    files = max(-(-total // per_file), 1)
    tasks = min(files, MOST_TASKS)
    rank = F.col("rank")
    spanned = rows.withColumns({
        "step": F.expr(f"rank div {per_step}"), "micro_batch": F.expr(f"rank div {batch_rows}"), "span": F.expr(f"rank div {per_file}"),
    })
    # neighbouring files share a task only if there are more files than tasks
    dealt = spanned.repartitionById(tasks, F.expr(f"cast(span div {-(-files // tasks)} as int)"))
    if make:
        dealt = make(dealt)
        dealt = dealt.select(*[F.col(f"`{c}`") for c in dealt.columns if c not in PLACES], *PLACES)
    folder = manifest.new_folder()
    dealt.sortWithinPartitions("span", rank).write.partitionBy("span").parquet(f"{path}/{folder}")
    stored = spark.read.schema(dealt.schema).parquet(f"{path}/{folder}")
    spans = stored.groupBy("span").agg(F.count(rank).alias("n"), F.min("rank").alias("low"), F.max("rank").alias("high"))
    whole = F.least(F.lit(total), (F.col("span") + 1) * per_file) - F.col("span") * per_file
    short = (F.col("n") != whole) | (F.col("low") != F.col("span") * per_file) | (F.col("high") != F.col("low") + whole - 1)
    seen = spans.agg(F.count(F.lit(1)).alias("files"), F.count(F.when(short, 1)).alias("short")).first()
    if seen.short or seen.files != -(-total // per_file):
        raise ValueError(f"ranks are not 0 to {total - 1}, each once")
    content = {"folder": folder, "schema": dealt.schema.jsonValue(), "rows": total, "batch_rows": batch_rows, "accumulation": accumulation, "steps_per_file": steps_per_file}
    manifest.commit(spark, path, version + 1, content)
    return -(-total // per_step)


def count_steps(spark: SparkSession, path: str) -> int:
    _, table = manifest.current(spark, path)
    return -(-table["rows"] // (table["batch_rows"] * table["accumulation"]))


def read_steps(
    spark: SparkSession, path: str, first: int = 0, last: int | None = None, process: int = 0, processes: int = 1
) -> DataFrame:
    """Rows of the steps from ``first`` to before ``last``, or to the end, that one of several processes uses.

    Only files of those steps are opened, and of a few steps only their folders are listed. A process takes every ``processes``-th micro
    batch of a step.
    """
    _, table = manifest.current(spark, path)
    if not table:
        raise ValueError(f"no step table at {path}")
    if not 0 <= process < processes:
        raise ValueError("process must be from 0 to processes - 1")
    span = table["steps_per_file"]
    folder, files = f"{path}/{table['folder']}", -(-table["rows"] // (table["batch_rows"] * table["accumulation"] * span))
    wanted = range(first // span, files if last is None else min(-(-last // span), files))
    # a whole table is listed by its root
    folders = [f"{folder}/span={i}" for i in wanted] if 0 < len(wanted) < files else [folder]
    stored = spark.read.schema(T.StructType.fromJson(table["schema"])).option("basePath", folder).parquet(*folders)
    rows = stored.filter((F.col("span") >= first // span) & (F.col("step") >= first))
    if last is not None:
        rows = rows.filter((F.col("span") <= max(last - 1, 0) // span) & (F.col("step") < last))
    if processes > 1:
        rows = rows.filter(F.col("micro_batch") % table["accumulation"] % processes == process)
    return rows.drop("span")
