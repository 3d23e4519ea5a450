"""Text tables to training rows. The same functions serve batch and streaming frames."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tokenloom.constants import MAX_SEQ_LEN
from tokenloom.functions import chat, sequences
from tokenloom.functions.bytelevel import lossy_utf8
from tokenloom.functions.codec import Encoder
from tokenloom.functions.pretokens import with_prefix_space


def pretrain_rows(
    df: DataFrame, encoder: Encoder, length: int = MAX_SEQ_LEN, text: str = "text", compat: bool = False, keep: tuple = ()
) -> DataFrame:
    """Pretraining rows.

    The text stands between begin and end id. Markers written around the text, as ``wrap_text`` does, give the same ids as
    the template, so they need not be written and found again; with ``compat`` both count and the ids are doubled.
    """
    ids = df.select(*keep, encoder.encode(F.col(text)).alias("_ids"))
    if compat:
        ids = ids.withColumn("_ids", sequences.add_bos_eos(F.col("_ids"), encoder.bos, encoder.eos))
    return ids.select(*keep, *sequences.pretrain_columns(F.col("_ids"), length, compat, encoder.pad))


def chat_ids(df: DataFrame, encoder: Encoder) -> DataFrame:
    """Columns ``prompt`` and ``answer``: ids of the rendered chat texts, without begin and end template."""
    prompt = chat.render_messages(chat.prompt_messages(F.col("instruct"), F.col("input")))
    answer = chat.render_messages(chat.answer_messages(F.col("output")))
    # a projection of its own, so that each text is rendered once however often encoding refers to it
    texts = df.withColumns({"prompt": prompt, "answer": answer})
    return texts.withColumns(
        {c: encoder.encode(F.col(c), template=False) for c in ("prompt", "answer")}
    )


def instruct_rows(
    df: DataFrame,
    encoder: Encoder,
    length: int = MAX_SEQ_LEN,
    compat: bool = False,
    label_pad: int | None = None,
    keep: tuple = (),
) -> DataFrame:
    """Instruct rows; with ``compat`` the input holds the prompt only. Labels are padded with the end id by default."""
    pad = encoder.eos if label_pad is None else label_pad
    ids = chat_ids(df, encoder).select(*keep, "prompt", "answer")
    return ids.select(
        *keep, *sequences.instruct_columns(F.col("prompt"), F.col("answer"), length, compat, encoder.eos, pad)
    )


def split_domain(df: DataFrame, vocab_size: int, ids: str = "input_ids") -> tuple[DataFrame, DataFrame]:
    """Rows whose ids all lie in ``[0, vocab_size)``, and the others."""
    bad = sequences.out_of_domain(F.col(ids), vocab_size)
    return df.filter(~bad), df.filter(bad)


def supervised_tokens(df: DataFrame, by: str, labels: str = "labels") -> DataFrame:
    """Label positions that enter the loss: sum and mean per group."""
    counted = df.select(by, sequences.supervised_count(F.col(labels)).alias("_n"))
    return counted.groupBy(by).agg(
        F.count(F.lit(1)).alias("rows"), F.sum("_n").alias("tokens"), F.avg("_n").alias("mean_tokens")
    )


def round_trip(df: DataFrame, encoder: Encoder, tokens: list[str], by: str, text: str = "text") -> DataFrame:
    """Encode, decode and compare, summed up per group."""
    coded = df.select(by, F.col(text).alias("_text"), encoder.round_trip(F.col(text), tokens).alias("_back"))
    same = lossy_utf8(F.col("_back.bytes")) == with_prefix_space(F.col("_text"))
    chars = F.length("_text").cast("long")
    size = F.col("_back.n").cast("long")
    return coded.groupBy(by).agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum(F.when(same, 0).otherwise(1)).alias("mismatches"),
        F.sum(size).alias("tokens"),
        (F.sum(chars) / F.sum(size)).alias("chars_per_token"),
    )
