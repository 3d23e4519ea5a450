"""Byte-level pre-tokenizing as native expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

from tokenloom.constants import JAVA_WORD_PATTERN, SPECIAL_TOKENS

_SPECIAL = "|".join(re.escape(t) for t in SPECIAL_TOKENS)
# All reserved tokens start with "<" and end with ">"; testing that one character first keeps most positions cheap.
_SPECIAL_HERE = f"(?=<)(?:{_SPECIAL})"
_SPECIAL_EDGE = f"(?=<)(?={_SPECIAL})|(?<=>)(?<={_SPECIAL})"


# Marks after words in a value of bytes.
WORD_END, OTHER_END = 0x01, 0xFF


def with_prefix_space(text: Column) -> Column:
    """One leading space, unless the text is empty or starts with U+0020."""
    return F.when((text == "") | text.startswith(" "), text).otherwise(F.concat(F.lit(" "), text))


def pretokens(text: Column) -> Column:
    """Words of a text without regard to reserved tokens (what training sees)."""
    return F.regexp_extract_all(with_prefix_space(text), F.lit(JAVA_WORD_PATTERN), F.lit(0))


def split_specials(text: Column) -> Column:
    """Text cut into reserved tokens and the pieces between them."""
    return F.filter(F.split(text, _SPECIAL_EDGE), lambda p: p != "")


def _has_special(text: Column) -> Column:
    return text.contains("<") & text.rlike(_SPECIAL_HERE)


def encode_words(text: Column) -> Column:
    """Words of a text with reserved tokens kept whole (what encoding sees).

    No ordinary word can equal a reserved token: the cut happens before the word pattern runs.
    """
    special_aware = F.flatten(
        F.transform(split_specials(text), lambda p: F.when(p.isin(SPECIAL_TOKENS), F.array(p)).otherwise(pretokens(p)))
    )
    return F.when(_has_special(text), special_aware).otherwise(pretokens(text))


def ended_words(text: Column, reserved: bool = True) -> Column:
    """Words as one value of bytes, with the byte ``WORD_END`` after each: those of ``encode_words``, or of ``pretokens`` if not ``reserved``.

    A text that holds that byte or a reserved token has ``OTHER_END`` instead, which is never part of UTF-8, and once more before its first word.
    The words of other texts follow each other without gaps, so the mark is put in place and no word becomes a value.
    """
    end = F.lit(bytearray([OTHER_END])).cast("string")
    other = F.concat(end, F.call_function("array_join", encode_words(text) if reserved else pretokens(text), end), end)
    put = F.regexp_replace(with_prefix_space(text), JAVA_WORD_PATTERN, "$0" + chr(WORD_END))
    found = text.contains(chr(WORD_END))
    return F.when(found | _has_special(text) if reserved else found, other).otherwise(put).cast("binary")
