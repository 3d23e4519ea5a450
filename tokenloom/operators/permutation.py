"""A random order that is computed, not sorted: a keyed permutation of the positions 0 to n - 1.

A position is written as two digits, ``left * b + right`` with ``left < a`` and ``right < b``, where ``a`` and ``b`` are about the square root
of n. A round adds a keyed hash of one digit to the other, modulo its base, which can be undone; some rounds make a permutation of
``a * b`` positions. The fewer than ``a`` positions from n on are left by cycle walking: a result among them is permuted
again until it is below n. How often that can happen in a row is found beforehand by following each of these positions,
so a column expression of fixed length does exactly what a loop would.

A row's rank then costs a few hashes, and needs neither a sort nor an exchange. The inverse gives the position of a rank.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field
from hashlib import md5

from pyspark.sql import Column, functions as F

from tokenloom.constants import SEED

ROUNDS = 6
# Hex digits of a round's hash; even for digits far beyond any table.
HASH_DIGITS = 12


@dataclass(frozen=True)
class Permutation:
    """Permutation of ``range(n)``, the same for the same ``n``, ``seed`` and ``epoch``."""

    n: int
    seed: int = SEED
    rounds: int = ROUNDS
    epoch: int = 0
    a: int = field(init=False)
    b: int = field(init=False)
    # most steps from a position below n to the next one below n
    walks: int = field(init=False)

    def __post_init__(self):
        if self.n < 0:
            raise ValueError("n must not be negative")
        a = max(math.isqrt(max(self.n - 1, 0)) + 1, 1)
        b = max(-(-self.n // a), 1)
        object.__setattr__(self, "a", a)
        object.__setattr__(self, "b", b)
        object.__setattr__(self, "walks", 1 + max(map(self._outside, range(self.n, a * b)), default=0))

    def _outside(self, position: int) -> int:
        """How many steps in a row end at ``n`` or above, if a step has led to ``position``; 0 for a cycle of such positions, which none leads to."""
        steps, begin = 1, position
        while (position := self._step(position)) >= self.n:
            if position == begin:
                return 0
            steps += 1
        return steps

    def _hash(self, turn: int, digit: int, base: int) -> int:
        return int(md5(f"{self.seed}:{self.epoch}:{turn}:{digit}".encode()).hexdigest()[:HASH_DIGITS], 16) % base

    def _step(self, position: int, sign: int = 1) -> int:
        left, right = divmod(position, self.b)
        for turn in range(self.rounds)[::sign]:
            if turn % 2:
                left = (left + sign * self._hash(turn, right, self.a)) % self.a
            else:
                right = (right + sign * self._hash(turn, left, self.b)) % self.b
        return left * self.b + right

    def rank(self, position: int) -> int:
        while (position := self._step(position)) >= self.n:
            pass
        return position

    def position(self, rank: int) -> int:
        while (rank := self._step(rank, -1)) >= self.n:
            pass
        return rank

    def _column(self, start: Column, sign: int) -> Column:
        """All turns of all walks as one fold over two digits; a walk begins only if the one before ended at ``n`` or above."""
        start = start.cast("long")

        def turned(state: Column, i: Column) -> Column:
            left, right = state["left"], state["right"]
            within = i % self.rounds
            turn = within if sign > 0 else self.rounds - 1 - within
            done = state["done"] | ((i > 0) & (within == 0) & (left * self.b + right < self.n))

            def added(digit: Column, other: Column, base: int) -> Column:
                text = F.concat(F.lit(f"{self.seed}:{self.epoch}:"), turn.cast("string"), F.lit(":"), other.cast("string"))
                hashed = F.conv(F.substring(F.md5(text), 1, HASH_DIGITS), 16, 10).cast("long") % base
                return F.pmod(digit + hashed * sign, F.lit(base).cast("long"))

            odd = turn % 2 == 1
            return F.struct(
                F.when(done | ~odd, left).otherwise(added(left, right, self.a)).alias("left"),
                F.when(done | odd, right).otherwise(added(right, left, self.b)).alias("right"), done.alias("done"),
            )

        # exact beyond 2**53, unlike a division of doubles
        left = F.call_function("div", start, F.lit(self.b).cast("long"))
        begin = F.struct(left.alias("left"), (start % self.b).cast("long").alias("right"), F.lit(False).alias("done"))
        turns = F.sequence(F.lit(0), F.lit(self.walks * self.rounds - 1))
        return F.aggregate(turns, begin, turned, lambda state: state["left"] * self.b + state["right"])

    def rank_column(self, position: Column) -> Column:
        """Rank of a position below ``n``, as a native expression."""
        return self._column(position, 1)

    def position_column(self, rank: Column) -> Column:
        """Position of a rank below ``n``, as a native expression."""
        return self._column(rank, -1)
