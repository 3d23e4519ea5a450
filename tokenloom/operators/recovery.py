"""Merges of a supplied vocabulary, and training that goes on from it.

A vocabulary names tokens and ids only. An encoder that knows no merges never produces a token of more than one byte, so
the merges are recovered: of each token, the bytes are merged by the tokens with lower ids, lowest id first, until none
applies. If two parts are left, they are the pair that an encoder joins last, and the merge that makes the token. The look-up
needs the ids of tokens but no other merge, so tokens are independent of each other and spread over tasks; what all tasks
need is the vocabulary, which is bounded. Ids give the order of merges.

A token with more parts left cannot be made by merging pairs of lower tokens, such as one whose parts have higher ids. It
keeps its id, and its merge is null. Training from the vocabulary can still make it: a learned pair that spells it takes its id.
"""

from __future__ import annotations

import heapq
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tokenloom.constants import SPECIAL_TOKENS, STAND_INS
from tokenloom.functions import bytelevel
from tokenloom.functions.codec import Encoder
from tokenloom.operators.merges import Merge
from tokenloom.operators.vocabulary import VOCAB_SCHEMA, extend_vocab, vocab_table
from tokenloom.session import ship_package


def final_parts(token: str, ids: Mapping[str, int]) -> list[str]:
    """What is left of a token when its characters are merged by tokens with lower ids, lowest id and leftmost first."""
    limit = ids[token]
    parts, n = list(token), len(token)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    heap: list[tuple[int, int, str]] = []

    def offer(i: int) -> None:
        if i >= 0 and after[i] < n:
            joined = parts[i] + parts[after[i]]
            found = ids.get(joined)
            if found is not None and found < limit:
                heapq.heappush(heap, (found, i, joined))

    for i in range(n - 1):
        offer(i)
    while heap:
        _, i, joined = heapq.heappop(heap)
        j = after[i]
        if not parts[i] or j >= n or len(parts[i]) + len(parts[j]) != len(joined) or parts[i] + parts[j] != joined:
            continue  # one of the two has been merged since
        parts[i], parts[j] = joined, ""
        after[i] = after[j]
        if after[i] < n:
            before[after[i]] = i
        offer(i)
        offer(before[i])
    return [p for p in parts if p]


def _bounded(vocab: DataFrame) -> list:
    rows = vocab.select("id", "token", "kind").limit(bytelevel.MAX_SYMBOLS + 1).collect()
    if len(rows) > bytelevel.MAX_SYMBOLS:
        raise ValueError("the vocabulary has more entries than token ids")
    return rows


def recover_merges(vocab: DataFrame) -> DataFrame:
    """``id, token, left, right`` of the tokens that merges make; ``left`` and ``right`` are null where no pair does.

    ``vocab`` is a vocabulary table; the byte alphabet may have any ids, a missing byte is in no merge.
    """
    spark = vocab.sparkSession
    ship_package(spark)
    rows = _bounded(vocab)
    shared = spark.sparkContext.broadcast(
        ({r.token: r.id for r in rows if r.kind == "merge"}, {r.token: r.id for r in rows if r.kind != "special"})
    )

    @F.arrow_udf("struct<left:int,right:int>")
    def pair(tokens: pa.Array) -> pa.Array:
        merged, known = shared.value
        found = []
        for token in tokens.to_pylist():
            parts = final_parts(token, merged)
            ids = [known.get(p) for p in parts]
            found.append({"left": ids[0], "right": ids[1]} if len(parts) == 2 and None not in ids else None)
        return pa.array(found, pa.struct([("left", pa.int32()), ("right", pa.int32())]))

    merges = vocab.filter(F.col("kind") == "merge").select("id", "token", pair("token").alias("p"))
    return merges.select("id", "token", "p.left", "p.right")


def complete(base: DataFrame) -> DataFrame:
    """A supplied vocabulary with the reserved tokens and bytes that it lacks, after its highest id."""
    return extend_vocab(base, vocab_table(base.sparkSession, []))


@dataclass(frozen=True)
class Base:
    """A vocabulary that training goes on from: token texts by id, ids of the bytes, and its merges in order."""

    texts: dict[int, str]
    byte_ids: list[int]
    merges: list[Merge]

    def encoder(self, spark, learned: Sequence[Merge] = ()) -> Encoder:
        """Encoder of the base and of merges learned after it."""
        ids = {text: i for i, text in self.texts.items()}
        return Encoder(spark, [*self.merges, *learned], self.byte_ids, {t: ids[t] for t in SPECIAL_TOKENS})


def base_of(vocab: DataFrame) -> Base:
    """Recovered merges and ids of a whole vocabulary table, bounded by the number of token ids.

    The table must hold all bytes and reserved tokens; :func:`complete` adds those that are missing.
    """
    rows = _bounded(vocab)
    texts = {r.id: r.token for r in rows}
    ids = {r.token: r.id for r in rows}
    if len(texts) != len(rows) or len(ids) != len(rows):
        raise ValueError("ids and tokens of a vocabulary must be unique")
    made = recover_merges(vocab).filter(F.col("left").isNotNull()).collect()
    merges = [Merge(r.left, r.right, r.id, 0) for r in sorted(made, key=lambda r: r.id)]
    return Base(texts, [ids[c] for c in STAND_INS], merges)


def joint_vocab(base_vocab: DataFrame, base: Base, learned: Sequence[Merge]) -> DataFrame:
    """The base vocabulary, unchanged, and the tokens that learned merges add."""
    texts = dict(base.texts)
    added = []
    for m in learned:
        if m.new_id not in texts:
            texts[m.new_id] = texts[m.left] + texts[m.right]
            added.append((m.new_id, texts[m.new_id], "merge"))
    table = base_vocab.sparkSession.createDataFrame(added, VOCAB_SCHEMA)
    columns = ["id", "token", "kind", "bytes"]
    return base_vocab.select(columns).unionByName(table.withColumn("bytes", bytelevel.from_stand_ins(F.col("token"))).select(columns))
