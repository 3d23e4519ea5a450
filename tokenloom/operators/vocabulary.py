"""Vocabulary tables. All are bounded by the vocabulary size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tokenloom.constants import BYTE_IDS, SPECIAL_TOKENS, STAND_INS
from tokenloom.functions import bytelevel
from tokenloom.operators.merges import Merge

VOCAB_SCHEMA = "id int, token string, kind string"


def token_texts(merges: Sequence[Merge]) -> list[str]:
    """Byte-level text of each token id."""
    texts = dict(enumerate(SPECIAL_TOKENS)) | dict(zip(BYTE_IDS, STAND_INS))
    for m in merges:
        texts[m.new_id] = texts[m.left] + texts[m.right]
    return [texts[i] for i in range(len(texts))]


def vocab_table(spark: SparkSession, merges: Sequence[Merge]) -> DataFrame:
    """Reserved tokens, byte alphabet and merges by id, with the bytes each token stands for."""
    base = len(SPECIAL_TOKENS), len(SPECIAL_TOKENS) + len(STAND_INS)
    rows = [
        (i, t, "special" if i < base[0] else "byte" if i < base[1] else "merge")
        for i, t in enumerate(token_texts(merges))
    ]
    table = spark.createDataFrame(rows, VOCAB_SCHEMA)
    return table.withColumn("bytes", bytelevel.from_stand_ins(F.col("token")))


def vocab_from_map(tokens: DataFrame) -> DataFrame:
    """Vocabulary table from rows ``token, id`` as read from a JSON map."""
    kind = F.when(F.col("token").isin(SPECIAL_TOKENS), "special").when(F.col("token").isin(STAND_INS), "byte").otherwise("merge")
    table = tokens.select(F.col("id").cast("int").alias("id"), "token", kind.alias("kind"))
    return table.withColumn("bytes", bytelevel.from_stand_ins(F.col("token")))


def special_tokens(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(i, t, True) for i, t in enumerate(SPECIAL_TOKENS)], "id int, content string, special boolean")


def extend_vocab(base: DataFrame, new: DataFrame, vocab_size: int | None = None) -> DataFrame:
    """Base vocabulary with its ids, then the tokens only in ``new``, in their order, from the highest id on.

    Added ids stay below ``vocab_size``, the size of the whole.
    """
    added = new.join(base, "token", "left_anti")
    top = base.agg(F.max("id").alias("top")).scalar()
    position = F.row_number().over(Window.orderBy("id"))
    columns = ["id", "token", "kind", "bytes"]
    added = added.withColumn("id", (top + position).cast("int")).select(columns)
    return base.select(columns).unionByName(added if vocab_size is None else added.filter(F.col("id") < vocab_size))


def relabel_merges(merges: DataFrame, old: DataFrame, vocab: DataFrame) -> DataFrame:
    """Merges learned under ``old`` ids, with the ids that ``vocab`` gives to the same tokens."""
    ids = old.select(F.col("id").alias("_old"), "token").join(vocab.select("id", "token"), "token").select("_old", "id")
    for column in ("left", "right", "new_id"):
        names = ids.select(F.col("_old").alias(column), F.col("id").alias("_id"))
        merges = merges.join(names, column).drop(column).withColumnRenamed("_id", column)
    return merges.select("rank", "left", "right", "new_id", "count")
