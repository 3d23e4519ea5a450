"""Slow single-process versions used as expected values."""

from __future__ import annotations

from collections import Counter

import regex

from tokenloom.constants import BYTE_IDS, FIRST_MERGE_ID, SPECIAL_TOKENS, STAND_INS, WORD_PATTERN


def pretokens(text: str) -> list[str]:
    if text and not text.startswith(" "):
        text = " " + text
    return regex.findall(WORD_PATTERN, text)


def merge(ids: tuple, left: int, right: int, new: int) -> tuple:
    out, i = [], 0
    while i < len(ids):
        if ids[i : i + 2] == (left, right):
            out.append(new)
            i += 2
        else:
            out.append(ids[i])
            i += 1
    return tuple(out)


def train(words: dict[str, int], vocab_size: int, min_frequency: int, texts: dict | None = None, known: list[tuple] = ()) -> list[tuple]:
    """One merge at a time with a full recount, after the ``known`` merges of a vocabulary with the token ``texts``."""
    texts = dict(texts or dict(enumerate(SPECIAL_TOKENS)) | dict(zip(BYTE_IDS, STAND_INS)))
    ids = {t: i for i, t in texts.items()}
    byte_ids = [ids[c] for c in STAND_INS]
    table = Counter()
    for word, n in words.items():
        table[tuple(encode_word(word, known, byte_ids))] += n
    merges = []
    following = max(texts) + 1
    while following < vocab_size:
        counts = Counter()
        for word, n in table.items():
            for pair in zip(word, word[1:]):
                counts[pair] += n
        if not counts:
            break
        pair, n = min(counts.items(), key=lambda item: (-item[1], item[0]))
        if n < min_frequency:
            break
        text = texts[pair[0]] + texts[pair[1]]
        new = ids.setdefault(text, following)
        following = max(following, new + 1)
        texts[new] = text
        merges.append((*pair, new, n))
        merged = Counter()
        for word, k in table.items():
            merged[merge(word, *pair, new)] += k
        table = merged
    return merges


def encode_word(word: str, merges: list[tuple], byte_ids: list[int] = BYTE_IDS) -> list[int]:
    ids = tuple(byte_ids[b] for b in word.encode())
    ranks = {tuple(m[:2]): (i, m[2]) for i, m in enumerate(merges)}
    while True:
        found = [(ranks[p][0], i) for i, p in enumerate(zip(ids, ids[1:])) if p in ranks]
        if not found:
            return list(ids)
        _, i = min(found)
        ids = ids[:i] + (ranks[ids[i : i + 2]][1],) + ids[i + 2 :]


def recover(token: str, ids: dict[str, int]) -> list[str]:
    """Parts of a token after merging by lower tokens, found by looking at all pairs each time."""
    parts = list(token)
    while True:
        found = [(ids[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if ids.get(a + b, ids[token]) < ids[token]]
        if not found:
            return parts
        i = min(found)[1]
        parts[i : i + 2] = [parts[i] + parts[i + 1]]


def render(messages: list[dict]) -> str:
    out = messages[0]["content"] if messages and messages[0]["role"] == "system" else ""
    for m in messages:
        if m["role"] == "user":
            out += "<s>user\n" + m["content"] + "</s>\n<s>assistant\n"
        elif m["role"] == "assistant":
            out += m["content"] + "</s>\n"
    return out


assert FIRST_MERGE_ID == 261
