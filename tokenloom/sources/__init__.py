"""Readers. Schemas are declared, never inferred."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tokenloom.sinks import manifest

WIKI_SCHEMA = "id string, url string, title string, text string"
PRETRAIN_SCHEMA = "text string"
INSTRUCT_SCHEMA = "instruct string, input string, output string"
ALPACA_SCHEMA = "instruction string, input string, output string"
ORCA_SCHEMA = "id string, system_prompt string, question string, response string"

CORRUPT = "_corrupt_record"


def read_subsets(spark: SparkSession, path: str, subsets: Sequence[str], column: str = "subset") -> DataFrame:
    """Rows of the named subsets; on a table partitioned by ``column`` only their directories are read."""
    return spark.read.parquet(path).filter(F.col(column).isin(list(subsets)))


def spread(df: DataFrame, *key: str) -> DataFrame:
    """Rows over all cores, if the input comes in fewer splits than there are cores.

    For work per row that costs far more than moving the row, on a plain scan. A large input has more splits and is left
    as it is.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, *key) if df.rdd.getNumPartitions() < cores else df


def read_config(spark: SparkSession, path: str, schema: str, config: str | None = None) -> DataFrame:
    """A data set, or one named configuration stored below it, as JSON lines; a broken line is an error."""
    return read_jsonl(spark, f"{path.rstrip('/')}/{config}" if config else path, schema)


def read_jsonl(spark: SparkSession, path: str, schema: str, keep_corrupt: bool = False) -> DataFrame:
    """JSON lines with a declared schema; with ``keep_corrupt`` a broken line is kept as text in its own column.

    Lines end at LF, as in the files that ``to_json`` writes.
    """
    declared = T.StructType.fromDDL(schema)
    if keep_corrupt:
        declared = declared.add(CORRUPT, "string")
    reader = spark.read.schema(declared).option("lineSep", "\n")
    if keep_corrupt:
        reader = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
    else:
        reader = reader.option("mode", "FAILFAST")
    return reader.json(path)


def stream_jsonl(
    spark: SparkSession, path: str, schema: str, files_per_trigger: int | None = None, keep_corrupt: bool = False
) -> DataFrame:
    """JSON lines as a stream; a broken line is an error, or text in its own column with ``keep_corrupt``."""
    declared = T.StructType.fromDDL(schema)
    reader = spark.readStream.schema(declared.add(CORRUPT, "string") if keep_corrupt else declared).option("lineSep", "\n")
    if keep_corrupt:
        reader = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
    else:
        reader = reader.option("mode", "FAILFAST")
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.json(path)


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Text files as rows ``line``, each with its line break; a partition column such as ``chunk`` is kept."""
    files = spark.read.option("lineSep", "\n").text(path)
    return files.withColumn("line", F.concat("value", F.lit("\n"))).drop("value")


def read_chunks(spark: SparkSession, path: str) -> DataFrame:
    """Rows ``line, chunk`` of the newest complete set of chunks; nothing if there is none."""
    _, content = manifest.current(spark, path)
    found = spark.createDataFrame([], "line string, chunk int")
    folders: dict[str, list[str]] = {}
    for chunk, folder in content.get("folders", {}).items():
        place, files = manifest.file_system(spark, f"{path.rstrip('/')}/{folder}/chunk={chunk}")
        # a chunk without rows has no folder
        if files.exists(place):
            folders.setdefault(folder, []).append(str(place))
    for folder, chunks in folders.items():
        files = spark.read.option("lineSep", "\n").option("basePath", f"{path.rstrip('/')}/{folder}").schema("value string, chunk int").text(chunks)
        found = found.unionByName(files.select(F.concat("value", F.lit("\n")).alias("line"), "chunk"))
    return found


def read_vocab_json(spark: SparkSession, path: str) -> DataFrame:
    """A JSON map from token to id as rows ``token, id``. The file is one value, bounded by the vocabulary size."""
    whole = spark.read.option("wholetext", True).text(path)
    return whole.select(F.explode(F.from_json("value", "map<string,int>")).alias("token", "id"))
