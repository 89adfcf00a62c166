"""Fixed-size filters of hashed keys, built by a grouped bit-or and sent to all tasks.

A sieve never loses a key that is in its set; a key that is not passes by chance, rarely
while the sieve is large for its set. It may only save work, never decide. Its size is a parameter (``of``) or
follows the number of keys up to a bound (``sized``), so what is broadcast and what the driver holds is bounded.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bits of a sieve (log 2); a key sets four of them.
LOG2 = 25
#: Least bits for a key of a sized sieve, where one in 40 strange keys passes, and most bits of all (log 2, 128 MB).
KEY_BITS, MOST_LOG2 = 8, 30


@dataclass
class Sieve:
    bits: np.ndarray

    @staticmethod
    def of(keys: DataFrame, log2: int = LOG2) -> Sieve:
        """The sieve of the distinct (a, b) of ``keys``, two 64-bit halves of a hash."""
        mask = (1 << log2) - 1
        shifts = [f"shiftrightunsigned({h}, {s}) & {mask}L" for h in "ab" for s in (0, 64 - log2)]
        places = keys.select(F.explode(F.expr(f"array({', '.join(shifts)})")).alias("at"))
        words = places.groupBy(F.expr("cast(at div 64 as int)").alias("w"))
        found = words.agg(F.expr("bit_or(shiftleft(1L, cast(at & 63 as int)))").alias("bits")).toArrow()
        bits = np.zeros(1 << (log2 - 6), dtype=np.int64)
        bits[found.column("w").to_numpy()] = found.column("bits").to_numpy()
        return Sieve(bits.view(np.uint64))

    @staticmethod
    def sized(keys: DataFrame, least: int = LOG2) -> Sieve:
        """The sieve of the distinct (a, b) of ``keys``, which are read twice, with room for all of them, up to ``MOST_LOG2``."""
        return Sieve.of(keys, Sieve.log2_for(keys.count(), least))

    @staticmethod
    def log2_for(keys: int, least: int = LOG2) -> int:
        return min(max(least, (KEY_BITS * keys - 1).bit_length()), max(least, MOST_LOG2))

    def holds(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether each key may be in the set; a and b are int64."""
        log2 = (64 * len(self.bits)).bit_length() - 1
        mask, out = np.uint64((1 << log2) - 1), np.ones(len(a), dtype=bool)
        for half in (a.view(np.uint64), b.view(np.uint64)):
            for shift in (0, 64 - log2):
                at = (half >> np.uint64(shift)) & mask
                out &= (self.bits[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1) == 1
        return out
