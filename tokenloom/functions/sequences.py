"""Fixed-length token rows from array columns.

``compat=True`` reproduces the literal behaviour that the README lists next to each default.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from tokenloom.constants import BOS, EOS, IGNORE, PAD


def add_bos_eos(ids: Column, bos: int = BOS, eos: int = EOS) -> Column:
    return F.concat(F.array(F.lit(bos)), ids, F.array(F.lit(eos)))


def pad_truncate(ids: Column, length: int, pad: int = IGNORE) -> Column:
    """Cut to ``length``, else pad on the right."""
    return F.concat(F.slice(ids, 1, length), F.array_repeat(F.lit(pad), F.greatest(F.lit(0), length - F.size(ids))))


def pretrain_columns(ids: Column, length: int, compat: bool = False, pad: int = PAD) -> list[Column]:
    """Input without the last position, labels without the first; both ``length - 1`` long."""
    inputs = F.slice(pad_truncate(ids, length, IGNORE if compat else pad), 1, length - 1)
    labels = F.slice(pad_truncate(ids, length, IGNORE), 2, length - 1)
    return [inputs.alias("input_ids"), labels.alias("output_ids" if compat else "labels")]


def mask_prompt(prompt: Column, answer: Column) -> Column:
    """Labels in which the prompt does not count."""
    return F.concat(F.array_repeat(F.lit(IGNORE), F.size(prompt)), answer)


def instruct_columns(
    prompt: Column, answer: Column, length: int, compat: bool = False, eos: int = EOS, label_pad: int = EOS
) -> list[Column]:
    """Input = prompt + answer (only the prompt in compat), labels masked over the prompt; both ``length`` long."""
    inputs = prompt if compat else F.concat(prompt, answer)
    return [
        pad_truncate(inputs, length, eos).alias("input_ids"),
        pad_truncate(mask_prompt(prompt, answer), length, label_pad).alias("labels"),
    ]


def supervised_count(labels: Column) -> Column:
    """Label positions that enter the loss."""
    return F.size(F.filter(labels, lambda x: x != IGNORE))


def out_of_domain(ids: Column, vocab_size: int) -> Column:
    return F.exists(ids, lambda i: (i < 0) | (i >= vocab_size))
