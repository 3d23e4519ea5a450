"""Lines, word frequencies, byte and pair counts: the aggregation core of tokenizer training."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from tokenloom.constants import BYTE_IDS, STAND_INS
from tokenloom.functions import bytelevel, pretokens
from tokenloom.functions.codec import split_words
from tokenloom.session import ship_package

# All adjacent symbol pairs of a symbol string, one match per symbol.
PAIRS = "(?s)(?=(..))."
# Bytes of words that are counted at a time.
COUNTED_BYTES = 16_000_000


def corpus_lines(df: DataFrame, text: str = "text", *keep: str) -> DataFrame:
    """One row per line; the line break stays part of the line."""
    lines = df.select(*keep, F.explode(F.split(F.col(text), "\n", -1)).alias("line"))
    return lines.withColumn("line", F.concat("line", F.lit("\n")))


def word_counts(lines: DataFrame, line: str = "line", batched: bool = False) -> DataFrame:
    """Distinct words with their frequency; counts are combined before the shuffle, so frequent words do not skew.

    With ``batched`` array kernels count some megabytes of lines at a time, so a row is a distinct word of these and not one occurrence.
    """
    if batched:
        ship_package(lines.sparkSession)
        ended = lines.select(pretokens.ended_words(F.col(line), reserved=False).alias("ended"))
        return ended.mapInArrow(_counted, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    words = lines.select(F.explode(pretokens.pretokens(F.col(line))).alias("word"))
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for words in _words(batches):
        found = pc.value_counts(words)
        yield pa.record_batch([found.field("values"), found.field("counts")], ["word", "n"])


def _words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Array]:
    """Words of lines with end marks, of some megabytes of lines at a time."""
    held, size = [], 0
    for batch in batches:
        rows = max(1, batch.num_rows * COUNTED_BYTES // max(1, batch.nbytes))
        for first in range(0, batch.num_rows, rows):
            held.append(split_words(batch.column(0).slice(first, rows)).flatten())
            size += held[-1].nbytes
            if size >= COUNTED_BYTES:
                yield pa.concat_arrays(held)
                held, size = [], 0
    if held:
        yield pa.concat_arrays(held)


def symbol_words(words: DataFrame) -> DataFrame:
    """Words as symbol strings ``s`` with frequency ``n``, before any merge."""
    return words.select(bytelevel.to_symbols(F.col("word")).alias("s"), "n")


def byte_alphabet() -> list[tuple[int, str, int]]:
    """Byte, printable stand-in and token id of the 256 base symbols."""
    return [(b, STAND_INS[b], BYTE_IDS[b]) for b in range(256)]


def symbol_counts(words: DataFrame) -> DataFrame:
    """Frequency of each symbol, weighted by word frequency."""
    symbols = words.select(F.explode(F.split("s", "")).alias("c"), "n")
    return symbols.groupBy("c").agg(F.sum("n").alias("n")).select(bytelevel.first_id(F.col("c")).alias("id"), "n")


def pair_strings(words: DataFrame) -> DataFrame:
    """Frequency of each adjacent symbol pair, the pair as a two-symbol string."""
    pairs = words.select(F.explode(F.regexp_extract_all("s", F.lit(PAIRS), F.lit(1))).alias("pair"), "n")
    return pairs.groupBy("pair").agg(F.sum("n").alias("n"))


def pair_ids(pair: Column) -> list[Column]:
    return [
        bytelevel.first_id(pair).alias("left"),
        bytelevel.first_id(F.substring(pair, 2, 1)).alias("right"),
    ]


def pair_counts(words: DataFrame) -> DataFrame:
    return pair_strings(words).select(*pair_ids(F.col("pair")), "n")
