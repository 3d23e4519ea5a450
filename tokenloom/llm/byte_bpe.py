"""Byte-level BPE encoding and decoding with the tiktoken library and a local rank file.

The driver reads the rank file (its size bounds what is broadcast). Texts of more than ``LONG`` characters are encoded in pieces. A piece
may start at any white space that follows a non-space character: no match of the split pattern holds a non-space
character before a space, and nothing in the pattern looks back, so the pieces' tokens are those of the whole text.

A null text counts as empty and has no tokens; bytes that are not UTF-8 become U+FFFD; null ids decode to null. Special
token strings in a text are ordinary text. Other columns may have any name and are kept.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tokenloom.session import ship_package

LONG = 1 << 16
_BOUNDARY = re.compile(r"(?<=\S)(?=\s)")


@lru_cache(maxsize=2)
def encoding(ranks: bytes, pattern: str) -> tiktoken.Encoding:
    table = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, ranks.splitlines())}
    return tiktoken.Encoding(hashlib.md5(ranks).hexdigest(), pat_str=pattern, mergeable_ranks=table, special_tokens={})


def pieces(text: str, size: int = LONG) -> Iterator[str]:
    """The text in pieces of about ``size`` characters that start at safe boundaries; a longer run stays whole."""
    start = 0
    while len(text) - start > size:
        cut = _BOUNDARY.search(text, start + size)
        if cut is None:
            break
        yield text[start : cut.start()]
        start = cut.start()
    yield text[start:]


def encode_text(codec: tiktoken.Encoding, text: str, size: int = LONG) -> np.ndarray:
    parts = [codec.encode_to_numpy(piece, disallowed_special=()) for piece in pieces(text, size)]
    return parts[0] if len(parts) == 1 else np.concatenate(parts)


def id_rows(ids: pa.Array) -> Iterator[np.ndarray | None]:
    """Rows of a list array one by one, as slices of its flat values."""
    flat, lengths = ids.flatten().to_numpy(zero_copy_only=False), ids.value_lengths()
    at = 0
    for length in lengths.to_pylist():
        yield None if length is None else flat[at : at + length]
        at += length or 0


class BytePairCodec:
    """Column functions for one rank file and split pattern."""

    def __init__(self, spark: SparkSession, path: str, pattern: str):
        ship_package(spark)
        with open(path, "rb") as file:
            self.ranks: Broadcast[bytes] = spark.sparkContext.broadcast(file.read())
        self.pattern = pattern

    def encode(self, text: Column) -> Column:
        """Token ids of a text as ``array<int>``."""
        ranks, pattern = self.ranks, self.pattern

        @F.arrow_udf("array<int>")
        def encoded(texts: pa.Array) -> pa.Array:
            codec = encoding(ranks.value, pattern)
            rows = [encode_text(codec, value.as_py().decode("utf-8", "replace")) for value in texts]
            offsets = np.cumsum([0, *map(len, rows)], dtype="int32")
            return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(rows or [[]]).astype("int32")))

        # marked so that Spark keeps it as one step, however many columns use the ids
        return encoded.asNondeterministic()(F.coalesce(text.cast("binary"), F.lit(b"")))

    def decode(self, ids: Column) -> Column:
        """The bytes that the ids stand for."""
        ranks, pattern = self.ranks, self.pattern

        @F.arrow_udf("binary")
        def decoded(rows: pa.Array) -> pa.Array:
            codec = encoding(ranks.value, pattern)
            return pa.array([None if row is None else codec.decode_bytes(row.tolist()) for row in id_rows(rows)], pa.binary())

        return decoded(ids)


def encode_documents(docs: DataFrame, codec: BytePairCodec, text: str = "text", out: str = "ids") -> DataFrame:
    """All columns of the input and the token ids."""
    return docs.withColumn(out, codec.encode(F.col(f"`{text}`")))


@F.arrow_udf(T.StringType())
def ids_sha256(ids: pa.Array) -> pa.Array:
    """Digest of the ids as little-endian unsigned 32-bit integers."""
    return pa.array([None if row is None else hashlib.sha256(row.astype("<u4").tobytes()).hexdigest() for row in id_rows(ids)], pa.string())
