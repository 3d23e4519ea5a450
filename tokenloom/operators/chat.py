"""Chat text from a long table of turns."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tokenloom.functions.chat import rendered_turn


def rendered_turns(
    turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """Turns with their chat text in ``piece``; system turns other than a leading one are gone.

    User and assistant turns render row by row. A system turn leads if it has the conversation's smallest turn number, a
    hash aggregate that combines before the shuffle, so a conversation of any length costs one row per task. The leading
    system turns are then found by an equi join on the unique (conversation, turn).
    """
    spoken = turns.withColumn("piece", rendered_turn(F.col(role), F.col(text))).select(conv, turn, "piece")
    first = turns.groupBy(conv).agg(F.min(turn).alias(turn))
    system = turns.filter(F.col(role) == "system").join(first, [conv, turn], "left_semi")
    return spoken.filter(F.col("piece").isNotNull()).unionByName(system.select(conv, turn, F.col(text).alias("piece")))


def render_conversations(
    turns: DataFrame,
    segment_turns: int,
    conv: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
) -> DataFrame:
    """Chat text joined per conversation and segment of ``segment_turns`` turn numbers.

    ``rendered_turns`` is the whole result, one row per turn. Joining needs a bound that the caller knows: a conversation
    of more turns becomes several rows whose texts follow each other.
    """
    pieces = rendered_turns(turns, conv, turn, role, text)
    ordered = F.array_sort(F.collect_list(F.struct(turn, "piece")))
    return (
        pieces.groupBy(conv, F.floor(F.col(turn) / segment_turns).alias("segment"))
        .agg(ordered.alias("_pieces"))
        .select(conv, "segment", F.array_join(F.transform("_pieces", lambda p: p["piece"]), "").alias("text"))
    )
