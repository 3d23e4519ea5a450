"""The three jobs: corpus, tokenizer, training rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from tokenloom import sinks, sources
from tokenloom.constants import (
    ACCUMULATION, BATCH_ROWS, CORPUS_CHUNKS, CORPUS_ROWS, HEAD_PERCENT, MAX_SEQ_LEN, MIN_FREQUENCY, SEED,
    TOKENIZER_FRACTION, VALIDATION_FRACTION, VOCAB_SIZE,
)
from tokenloom.functions.codec import Encoder
from tokenloom.operators import columns, merges, places, ranking, recovery, training_rows, vocabulary, wordstats
from tokenloom.operators.batches import assign_batches, assign_batches_by_place
from tokenloom.sinks import steps


def build_corpus(
    rows: DataFrame, out: str, subsets: Sequence[str], size: int = CORPUS_ROWS, by: str = "subset",
    key: str | Sequence[str] = "id", seed: int = SEED, strict: bool = False,
) -> DataFrame:
    """Equal random samples of the subsets, shuffled, as JSON lines; returns the row count per subset.

    A subset with too few rows is kept whole, or is an error with ``strict``.
    """
    wanted = int(size // len(subsets))
    sample = ranking.sample_per_subset(rows, wanted, by, key, seed, subsets)
    if strict:
        present = {r[by]: r["count"] for r in rows.filter(F.col(by).isin(list(subsets))).groupBy(by).count().collect()}
        short = {s: present.get(s, 0) for s in subsets if present.get(s, 0) < wanted}
        if short:
            raise ValueError(f"subsets with fewer than {wanted} rows: {short}")
    sinks.write_jsonl(ranking.shuffle_rows(sample, key, seed), out)
    written = sources.read_jsonl(rows.sparkSession, out, f"`{by}` string")
    return written.groupBy(by).agg(F.count(F.lit(1)).alias("rows"))


def instruct_union(alpaca: DataFrame, orca: DataFrame) -> DataFrame:
    """Both instruct sources under the common names."""
    return columns.union_sources(
        columns.rename_columns(alpaca, columns.ALPACA_NAMES),
        columns.rename_columns(columns.drop_columns(orca, "id"), columns.ORCA_NAMES),
    )


def build_instruct(
    rows: DataFrame, out: str, key: str | Sequence[str], fraction: float = VALIDATION_FRACTION, seed: int = SEED
) -> None:
    """Shuffled instruct rows as JSON lines below ``out/part=train`` and ``out/part=test``, written in one pass."""
    parted = ranking.split_exact(rows, fraction, key, seed)
    ranking.shuffle_rows(parted, key, seed, first=["part"]).write.partitionBy("part").json(out)


def tokenizer_corpus(
    rows: DataFrame, key: str | Sequence[str] | None, seed: int = SEED, percent: float = HEAD_PERCENT,
    chunks: int = CORPUS_CHUNKS, title: str | None = None, compat: bool = False,
) -> DataFrame:
    """First ``percent`` of the shuffled rows, cut into chunks, with columns ``text`` and ``chunk``.

    Without a ``key`` the rows come straight from files and are taken in the order they have there.
    """
    text: Column = F.col("text") if title is None else columns.title_text(F.col(title), F.col("text"))
    if key is None:
        return places.chunks_by_place(rows, chunks, compat, percent).withColumn("text", text)
    order = ranking.seeded_order(key, seed)
    return ranking.corpus_chunks(rows, chunks, order, compat, percent).withColumn("text", text)


def tokenizer_sample(
    rows: DataFrame, subsets: Sequence[str], by: str = "subset", key: str | Sequence[str] = "id", seed: int = SEED,
    fraction: float = TOKENIZER_FRACTION, title: str = "title", dropped: Sequence[str] = ("id", "url", "title"),
    compat: bool = False,
) -> DataFrame:
    """``fraction`` of each subset with the title in front, without the ``dropped`` columns.

    The subsets follow each other as listed and are cut into as many chunks.
    """
    parted = ranking.split_exact(rows, fraction, key, seed, by, subsets).filter(F.col("part") == "test").drop("part")
    listed = F.array_position(F.lit(list(subsets)), F.col(by))
    chunked = ranking.corpus_chunks(parted, len(subsets), ranking.seeded_order(key, seed, first=listed), compat)
    named = chunked.withColumn("text", columns.title_text(F.col(title), F.col("text")))
    return columns.drop_columns(named, *dropped)


def train_tokenizer(
    corpus: DataFrame, out: str, chunks: int = CORPUS_CHUNKS, vocab_size: int = VOCAB_SIZE, min_frequency: int = MIN_FREQUENCY,
    base: DataFrame | None = None,
) -> list[merges.Merge]:
    """Write the chunk files, learn merges from them and save vocabulary, merges and settings below ``out``.

    With a ``base`` vocabulary (rows ``token, id``) training goes on from it: its ids are kept, its merges are recovered
    and come first, and the merges learned after them, which are returned, add tokens with ids below ``vocab_size``. Only
    chunks of this call are read.
    """
    spark = corpus.sparkSession
    sinks.write_chunks(corpus, f"{out}/corpus", chunks)
    words = wordstats.word_counts(sources.read_chunks(spark, f"{out}/corpus"))
    symbols = wordstats.symbol_words(words)
    if base is None:
        learned = merges.learn_merges(symbols, vocab_size, min_frequency)
        vocab, merge_list = vocabulary.vocab_table(spark, learned), merges.merges_table(spark, learned)
    else:
        known = recovery.complete(vocabulary.vocab_from_map(base))
        start = recovery.base_of(known)
        learned = merges.learn_merges(symbols, vocab_size, min_frequency, base=start)
        vocab, merge_list = recovery.joint_vocab(known, start, learned), merges.merges_table(spark, [*start.merges, *learned])
    sinks.write_table(vocab, f"{out}/vocab", "overwrite")
    sinks.write_table(merge_list, f"{out}/merges", "overwrite")
    sinks.write_vocab_json(vocab, f"{out}/vocab-json", "overwrite")
    sinks.write_merges_text(merge_list, vocab, f"{out}/merges-text", "overwrite")
    sinks.write_tokenizer_json(merge_list, vocab, f"{out}/tokenizer-json", "overwrite")
    sinks.write_settings(spark, f"{out}/settings", "overwrite")
    return learned


def load_encoder(spark: SparkSession, path: str) -> Encoder:
    return Encoder.from_tables(spark.read.parquet(f"{path}/vocab"), spark.read.parquet(f"{path}/merges"))


def _reject(kind: str) -> Column:
    if kind == "pretrain":
        return columns.pretrain_reject(F.col("text"))
    if kind == "instruct":
        return columns.instruct_reject(F.col("instruct"), F.col("input"), F.col("output"))
    raise ValueError(f"unknown kind: {kind}")


def _write_rejects(rows: DataFrame, kind: str, path: str) -> tuple[DataFrame, int]:
    """Write the unusable rows; the usable ones, and their number, which the same pass over the rows counts."""
    reason, seen = _reject(kind), Observation()
    counted = rows.observe(seen, F.count(F.when(reason.isNull(), 1)).alias("usable"))
    sinks.write_table(columns.split_rejects(counted, reason)[1], path)
    return columns.split_rejects(rows, reason)[0], seen.get["usable"]


def _training_rows(
    kind: str, rows: DataFrame, encoder: Encoder, length: int, compat: bool, label_pad: int | None, keep: Sequence[str]
) -> DataFrame:
    if kind == "pretrain":
        return training_rows.pretrain_rows(rows, encoder, length, compat=compat, keep=keep)
    return training_rows.instruct_rows(rows, encoder, length, compat, label_pad, keep)


def build_step_rows(
    rows: DataFrame, kind: str, encoder: Encoder, out: str, length: int = MAX_SEQ_LEN, seed: int = SEED, batch_rows: int = BATCH_ROWS,
    accumulation: int = ACCUMULATION, max_steps: int | None = None, epochs: int = 1, compat: bool = False, label_pad: int | None = None,
    keep: Sequence[str] = (), steps_per_file: int = steps.STEPS_PER_FILE,
) -> int:
    """Usable rows of files as token rows addressed by step below ``out/rows``, unusable ones below ``out/rejects``; returns the number of steps.

    ``rows`` come straight from files and need no key: a row's rank is a permutation of its place there, with an order of its own
    for each of the ``epochs``. Rows move once, to the file of their step, as text, and are encoded there; ``steps.read_steps`` reads them.
    """
    good, usable = _write_rejects(rows, kind, f"{out}/rejects")
    placed = assign_batches_by_place(good, seed, batch_rows, accumulation, max_steps, epochs, usable)
    total = usable * epochs
    if max_steps is not None:
        total = min(total, max_steps * batch_rows * accumulation)
    kept = tuple(dict.fromkeys((*keep, "rank", *steps.PLACES)))

    def made(dealt: DataFrame) -> DataFrame:
        return sinks.as_int64(_training_rows(kind, dealt, encoder, length, compat, label_pad, kept))

    return steps.write_steps(placed, f"{out}/rows", total, batch_rows, accumulation, steps_per_file, made)


def build_training_rows(
    rows: DataFrame, kind: str, encoder: Encoder, out: str, key: str | Sequence[str], length: int = MAX_SEQ_LEN,
    seed: int = SEED, batch_rows: int = BATCH_ROWS, accumulation: int = ACCUMULATION, max_steps: int | None = None,
    compat: bool = False, label_pad: int | None = None,
) -> int:
    """Usable rows as token rows with micro batch and step below ``out/rows``, unusable ones below ``out/rejects``.

    All usable rows are written. Only a caller who names ``max_steps`` (the published run has ``MAX_STEPS``) gets the rows
    of so many steps; the result is the number of usable rows left out. Batches are assigned before encoding, so those
    are never encoded and the exchange carries text instead of padded sequences.
    """
    keep = (*([key] if isinstance(key, str) else key), "rank", "micro_batch", "step")
    good, usable = _write_rejects(rows, kind, f"{out}/rejects")
    placed = assign_batches(good, key, seed, batch_rows, accumulation, max_steps)
    made = _training_rows(kind, placed, encoder, length, compat, label_pad, keep)
    sinks.write_table(sinks.as_int64(made), f"{out}/rows")
    return 0 if max_steps is None else max(usable - max_steps * batch_rows * accumulation, 0)
