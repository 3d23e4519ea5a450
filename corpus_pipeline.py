"""Corpus pipeline: documents without toxic ones and copies, mixed by source, as token ids.

Each stage takes (spark, docs, sf_dir) and returns a frame; all but the last return the columns of ``documents``. A driver may
write every stage as Parquet and read it again, ``run`` chains them. No SQL can express the stages that learn, hash
shingles or encode; tests compare each of them with a plain version.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from tokenloom.llm import byte_bpe, exact_dedup, minhash, mixing, toxicity
from tokenloom.llm.queries import MIX_EPOCHS, MIX_WEIGHTS, RANKS, TOXIC_FROM, toxicity_model


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a score below the threshold; the model learns from the labelled ones among them.

    Nothing goes where the labels teach no difference.
    """
    model = toxicity_model(spark, docs, sf_dir)
    if not model.ratios:
        return docs
    scored = toxicity.score_documents(docs, model, out="_toxicity")
    return scored.filter(F.col("_toxicity.score") < TOXIC_FROM).drop("_toxicity")


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text, the one with the smallest id."""
    return exact_dedup.exact_dedup(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies, the one with the smallest id."""
    return minhash.near_dedup(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them: not at all, or up to ``MIX_EPOCHS`` times."""
    return mixing.mix(docs, MIX_WEIGHTS, max_epochs=MIX_EPOCHS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every row, and whether they decode to its text."""
    codec = byte_bpe.BytePairCodec(spark, public_tokenizers.path(RANKS), public_tokenizers.PATTERN)
    encoded = byte_bpe.encode_documents(docs.select("doc_id", "text"), codec)
    same = codec.decode(F.col("ids")) == F.coalesce(F.col("text").cast("binary"), F.lit(b""))
    return encoded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", same.alias("decodes"))


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("byte_bpe", encode),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    frame = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        frame = stage(spark, frame, sf_dir)
    return frame
