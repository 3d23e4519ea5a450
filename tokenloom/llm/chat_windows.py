r"""Chat formatting in budgeted windows.

Turns of a conversation, in order, are laid out by prefix sums of their tokens. Windows are the turn-aligned spans that
start in the same stretch of ``width`` tokens; ``width`` is half of what the budget leaves beside the leading system turn and
the history, so that a span with its last turn still fits. Each window repeats the leading system turn and the turns
that start in the last ``history / 2`` tokens before its stretch and are no longer than that. Targets are the assistant
texts; a repeated one is masked, so each is under the loss once. A turn is never cut: a window exceeds its budget only where a turn
is longer than ``width``, or where the system turn leaves less than ``LEAST`` tokens.

A turn reads ``<|role|>text<|end|>``. Inside roles and texts every ``<``, ``[``, ``|`` and ``\`` is followed by an inserted ``\``, so
control strings (also ``</s>`` or ``[INST]``) cannot occur there, and dropping the inserted characters restores the text.

Prefix sums have two levels, blocks of ``BLOCK`` turn numbers and turns in a block, so a conversation with a third of all
turns is many small groups; only one narrow row per block meets in a conversation's window.

Defined results: null texts and roles are empty; turns with a null number come last, equal numbers are ordered by role and
text; a null conversation is a conversation; an empty table gives no window; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F

BUDGET = 1024
HISTORY = 256
LEAST = 128
BLOCK = 256
END = "<|end|>"
TURN_MARKS = 4


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"([<\[|\\])", r"$1\\")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"([<\[|\\])\\", "$1")


def turn_tokens(text: Column) -> Column:
    """Words of ASCII letters and digits and all other visible characters, and the marks of a turn."""
    return F.regexp_count(text, F.lit(r"[A-Za-z0-9]+|[^A-Za-z0-9\x20\x09-\x0D]")) + F.lit(TURN_MARKS)


def _laid_out(turns: DataFrame, budget: int, history: int) -> DataFrame:
    """Turns with ``start`` (tokens before them, the leading system turn apart), ``lead``, ``width`` and ``all`` (tokens in sum)."""
    order = F.struct(F.col("turn").isNull().alias("last"), "turn", "role", "mark", "tokens")
    turns = turns.withColumn("order", order).withColumn("key", F.struct("conv", F.floor(F.col("turn") / BLOCK).alias("block")))
    blocks = turns.groupBy("key").agg(F.sum("tokens").alias("block_tokens"), F.min("order").alias("first"))
    conversation = Window.partitionBy("key.conv")
    upto = conversation.orderBy(F.col("key.block").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select(
        F.col("key").alias("at"), F.coalesce(F.sum("block_tokens").over(upto), F.lit(0)).alias("before"),
        F.sum("block_tokens").over(conversation).alias("all"), F.min("first").over(conversation).alias("opening"),
        (F.count(F.lit(1)).over(upto) == 0).alias("first_block"),
    )
    system = F.when(F.col("opening.role") == "system", F.col("opening.tokens")).otherwise(0)
    blocks = blocks.withColumn("system", system)
    inside = Window.partitionBy("key").orderBy("order")
    run = F.coalesce(F.sum("tokens").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = turns.join(blocks, F.col("key") == F.col("at")).withColumn("number", F.row_number().over(inside))
    placed = placed.withColumn("start", F.col("before") + run - F.col("system"))
    lead = F.col("first_block") & (F.col("number") == 1) & (F.col("role") == "system")
    width = F.greatest(F.floor((F.lit(budget - history) - F.col("system")) / 2), F.lit(LEAST))
    return placed.withColumn("lead", lead).withColumn("width", width).withColumn("all", F.col("all") - F.col("system"))


def format_windows(
    turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
    budget: int = BUDGET, history: int = HISTORY, tokens: Callable[[Column], Column] = turn_tokens,
) -> DataFrame:
    """One row per window: ``conv, window, formatted, spans``.

    ``spans`` has a row per turn of the window, in order: ``begin`` and ``end`` of its escaped text in ``formatted`` (code
    points), ``turn``, ``target`` (under the loss) and ``repeated``.
    """
    if not 0 <= history < budget:
        raise ValueError("history must be smaller than the budget")
    body, who = F.coalesce(F.col(f"`{text}`"), F.lit("")), F.coalesce(F.col(f"`{role}`"), F.lit(""))
    rows = turns.select(
        F.col(f"`{conv}`").alias("conv"), F.col(f"`{turn}`").alias("turn"), who.alias("role"), body.alias("text"),
        F.xxhash64(body).alias("mark"), tokens(body).cast("long").alias("tokens"),
    )
    reach = history // 2
    rows = _laid_out(rows, budget, history)
    own = F.floor(F.col("start") / F.col("width"))
    until = F.when(F.col("tokens") <= reach, F.floor((F.col("start") + reach) / F.col("width"))).otherwise(own)
    last = F.greatest(F.floor((F.col("all") - 1) / F.col("width")), F.lit(0))
    windows = F.when(F.col("lead"), F.sequence(F.lit(0).cast("long"), last)).otherwise(F.sequence(own, until))
    head = F.concat(F.lit("<|"), escape(F.col("role")), F.lit("|>"))
    rows = rows.select(
        "conv", "turn", "role", "lead", "start", head.alias("head"), escape(F.col("text")).alias("body"),
        F.when(F.col("lead"), F.lit(0).cast("long")).otherwise(own).alias("own"), F.explode(windows).alias("window"),
    )
    group = Window.partitionBy("conv", "window").orderBy(F.col("lead").desc(), "start")
    size = F.length("head") + F.length("body") + F.lit(len(END))
    begin = F.coalesce(F.sum(size).over(group.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) + F.length("head")
    repeated = F.col("own") != F.col("window")
    rows = rows.withColumn("begin", begin).withColumn("repeated", repeated)
    span = F.struct(
        "begin", (F.col("begin") + F.length("body")).alias("end"), "turn",
        ((F.col("role") == "assistant") & ~repeated).alias("target"), "repeated",
    )
    piece = F.struct(F.col("begin").alias("order"), F.concat("head", "body", F.lit(END)).alias("piece"), span.alias("span"))
    formed = rows.groupBy("conv", "window").agg(F.array_sort(F.collect_list(piece)).alias("pieces"))
    formed = formed.filter(F.exists("pieces", lambda p: ~p["span"]["repeated"]))
    return formed.select("conv", "window", F.array_join("pieces.piece", "").alias("formatted"), F.col("pieces.span").alias("spans"))


def read_turns(windows: DataFrame) -> DataFrame:
    """Windows with ``turns``: role and text of every turn, read back from the formatted text."""
    pieces = F.slice(F.split("formatted", r"<\|end\|>"), 1, F.size("spans"))
    parsed = F.transform(pieces, lambda p: F.struct(
        unescape(F.regexp_extract(p, r"(?s)^<\|(.*?)\|>", 1)).alias("role"),
        unescape(F.regexp_extract(p, r"(?s)^<\|.*?\|>(.*)$", 1)).alias("text"),
    ))
    return windows.withColumn("turns", parsed)


def loss_text(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask of a window, unescaped."""
    targets = F.filter(spans, lambda s: s["target"])
    texts = F.transform(targets, lambda s: unescape(F.substring(formatted, s["begin"].cast("int") + 1, (s["end"] - s["begin"]).cast("int"))))
    return F.array_join(texts, "")
