"""Messages and chat text for array columns."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from tokenloom.constants import ASSISTANT_CLOSE, USER_CLOSE, USER_OPEN


def _message(role: str, content: Column) -> Column:
    return F.struct(F.lit(role).alias("role"), content.alias("content"))


def prompt_messages(instruct: Column, input_: Column) -> Column:
    """System and user message; an empty or null part is left out."""
    both = F.array(_message("system", instruct), _message("user", input_))
    return F.filter(both, lambda m: m["content"].isNotNull() & (m["content"] != ""))


def answer_messages(output: Column) -> Column:
    return F.array(_message("assistant", output))


def rendered_turn(role: Column, content: Column) -> Column:
    """Chat text of a user or assistant message, null for any other role."""
    return F.when(role == "user", F.concat(F.lit(USER_OPEN), content, F.lit(USER_CLOSE))).when(
        role == "assistant", F.concat(content, F.lit(ASSISTANT_CLOSE))
    )


def render_messages(messages: Column) -> Column:
    """Chat text of a message list; only a leading system message counts."""
    pieces = F.transform(
        messages,
        lambda m, i: F.when((i == 0) & (m["role"] == "system"), m["content"]).otherwise(
            rendered_turn(m["role"], m["content"])
        ),
    )
    return F.array_join(pieces, "")
