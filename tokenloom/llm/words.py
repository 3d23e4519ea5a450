"""Words of many texts at once, where all separators are single ASCII bytes."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32


def byte_set(chars: bytes) -> np.ndarray:
    """Membership of each byte value."""
    found = np.zeros(256, dtype=bool)
    found[np.frombuffer(chars, np.uint8)] = True
    return found


def split_words(texts: pa.Array, gaps: np.ndarray, stops: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Words of texts, A-Z lower-cased: number of the text, number of the piece, and the words as binary.

    ``gaps`` are the bytes between words and ``stops`` those that also end a piece. Bytes of 128 and more are in neither, so no
    character is cut. Null texts have no words.
    """
    flat = pc.fill_null(texts.cast(pa.large_binary()), b"")
    bounds = np.frombuffer(flat.buffers()[1], np.int64)[flat.offset : flat.offset + len(flat) + 1] if len(flat) else np.zeros(1, np.int64)
    none = np.zeros(0, np.int64)
    if bounds[-1] == bounds[0]:
        return none, none, pa.array([], pa.binary())
    data = _LOWER[np.frombuffer(flat.buffers()[2], np.uint8)[bounds[0] : bounds[-1]]]
    bounds = bounds - bounds[0]
    inside = ~(gaps if stops is None else gaps | stops)[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    firsts = bounds[:-1][np.diff(bounds) > 0]
    begins[firsts] = inside[firsts]
    at = np.flatnonzero(begins)
    owner = np.searchsorted(bounds, at, "right") - 1
    piece = owner if stops is None else owner + np.cumsum(stops[data])[at]
    letters = data[inside]
    starts = np.r_[np.cumsum(inside)[at] - 1, len(letters)].astype(np.int32)
    words = pa.Array.from_buffers(pa.binary(), len(at), [None, pa.py_buffer(starts), pa.py_buffer(letters)])
    return owner, piece, words


def coded(words: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Number of each word in the list of distinct words, and that list."""
    found = words.dictionary_encode()
    return np.asarray(found.indices.to_numpy(zero_copy_only=False), np.int64), found.dictionary


def sums(keys: np.ndarray, weights: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, ascending, and the sum of their weights."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    at = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, np.int64)
    if weights is None:
        return keys[at], np.diff(np.r_[at, len(keys)])
    return keys[at], np.add.reduceat(weights[order], at) if len(at) else weights[:0]
