"""Integer string hash, seeded coefficients and the universal hash family.

Every helper here either runs once on the driver over a handful of integers
(``coefficients``) or returns a ``Column``; no data passes through Python.
"""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

# 2^31-1, the modulus of the MinHash family, and the public
# parameters of the 48-bit linear congruential generator that fixes the hash
# coefficients for a given seed.
MERSENNE_31 = 2_147_483_647
LCG_MULTIPLIER = 25_214_903_917
LCG_INCREMENT = 11
LCG_MODULUS = 2**48


def _lcg_31(seed: int):
    """Endless stream of the generator's upper 31 bits."""
    state = (seed ^ LCG_MULTIPLIER) % LCG_MODULUS
    while True:
        state = (state * LCG_MULTIPLIER + LCG_INCREMENT) % LCG_MODULUS
        yield state // 2**17


def _below(bits, bound: int) -> int:
    """Uniform draw in [0, bound); draws from the last partial range are redrawn."""
    usable = 2**31 - 2**31 % bound
    return next(b for b in bits if b < usable) % bound


@lru_cache(maxsize=64)
def coefficients(count: int, seed: int) -> tuple[tuple[int, int], ...]:
    """``count`` pairs (a, b) with 1 <= a < 2^31-1 and 0 <= b < 2^31-1."""
    if count <= 0:
        raise ValueError("the number of hash functions must be positive")
    bits = _lcg_31(seed)
    return tuple(
        (_below(bits, MERSENNE_31 - 1) + 1, _below(bits, MERSENNE_31)) for _ in range(count)
    )


def java_hash(text: Column) -> Column:
    """Signed 32-bit polynomial hash (base 31) over UTF-16 code units, as BIGINT.

    NULL hashes to 0. The running value is masked to 32 bits in BIGINT so ANSI
    overflow checks never fire; code points above U+FFFF fold as two surrogates.
    """
    mask = F.lit(0xFFFFFFFF)

    def fold(h: Column, ch: Column) -> Column:
        cp = F.ascii(ch).cast("bigint")
        high = F.shiftright(cp - 0x10000, 10) + 0xD800
        low = (cp - 0x10000).bitwiseAND(F.lit(0x3FF)) + 0xDC00
        return F.when(cp < 0x10000, (h * 31 + cp).bitwiseAND(mask)).otherwise(
            ((h * 31 + high) * 31 + low).bitwiseAND(mask)
        )

    def to_signed(h: Column) -> Column:
        return F.when(h >= 2**31, h - 2**32).otherwise(h)

    chars = F.split(F.coalesce(text, F.lit("")), "")
    return F.aggregate(chars, F.lit(0).cast("bigint"), fold, to_signed)


def universal_hash(h: Column, a: int, b: int, modulus: int) -> Column:
    """``(a*h + b) mod modulus`` in [0, modulus); |a*h + b| stays below 2^63."""
    return F.pmod(F.lit(a).cast("bigint") * h + F.lit(b).cast("bigint"), F.lit(modulus).cast("bigint"))
