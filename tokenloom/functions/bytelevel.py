"""Text to bytes and back, as native column expressions.

Reading UTF-8 bytes as Latin-1 gives a string with one character per byte, so ``translate`` can map bytes
to any other one-character code in a single linear pass.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from tokenloom.constants import BYTE_IDS, STAND_INS

# A symbol id is carried as one supplementary-plane character, so a word in any state of merging is a string
# and a merge is a plain string replacement.
SYMBOL_BASE = 0x10000
MAX_SYMBOLS = 0x110000 - SYMBOL_BASE

_BYTE_CHARS = "".join(chr(b) for b in range(256))
_STAND_IN_CHARS = "".join(STAND_INS)
_BYTE_OF = str.maketrans(_STAND_IN_CHARS, _BYTE_CHARS)
# Never part of a text of bytes, so it can separate them.
STAND_IN_ZERO = STAND_INS[0]


def symbol(token_id: int) -> str:
    return chr(SYMBOL_BASE + token_id)


def symbol_id(char: str) -> int:
    return ord(char) - SYMBOL_BASE


_SYMBOL_CHARS = "".join(symbol(i) for i in BYTE_IDS)


def byte_chars(text: Column) -> Column:
    return F.decode(F.encode(text, "UTF-8"), "ISO-8859-1")


def to_stand_ins(text: Column) -> Column:
    """Byte-level token text: one printable stand-in per byte."""
    return F.translate(byte_chars(text), _BYTE_CHARS, _STAND_IN_CHARS)


def from_stand_ins(token_text: Column) -> Column:
    """Bytes of byte-level token text.

    ``translate`` takes a NUL in its target for a deletion, so byte 0 is put in separately.
    """
    chars = F.translate(token_text, _STAND_IN_CHARS[1:], _BYTE_CHARS[1:])
    return F.encode(F.replace(chars, F.lit(_STAND_IN_CHARS[0]), F.lit("\0")), "ISO-8859-1")


def byte_text(token: str) -> str:
    """Byte-level token text with one Latin-1 character per byte."""
    return token.translate(_BYTE_OF)


def to_symbols(text: Column) -> Column:
    """One symbol character per byte, before any merge."""
    return F.translate(byte_chars(text), _BYTE_CHARS, _SYMBOL_CHARS)


def symbol_ids(symbols: Column) -> Column:
    """array<int> of the ids in a symbol string."""
    return F.when(symbols == "", F.array().cast("array<int>")).otherwise(
        F.transform(F.split(symbols, ""), lambda c: F.ascii(c) - SYMBOL_BASE)
    )


def first_id(symbols: Column) -> Column:
    return F.ascii(symbols) - SYMBOL_BASE


def byte_ids(text: Column) -> Column:
    """Token ids of a text when no merge has been learned."""
    return symbol_ids(to_symbols(text))


def lossy_utf8(data: Column) -> Column:
    """Bytes to text; broken sequences become U+FFFD."""
    return F.make_valid_utf8(data.cast("string"))
