"""Bloom filter bits as BIGINT words, and their Base64 text form.

A filter of m bits is held as m/64 words so that a plain ``bit_or`` aggregates it
with map-side combine. The text form is Base64 over little-endian bytes with the
trailing zero bytes dropped; an empty filter is the empty string.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from feedlake.functions.hashing import coefficients


def words_with(h: Column, bits: int, hashes: int, seed: int) -> Column:
    """ARRAY<BIGINT> of words holding the k bits of an element whose string hash is ``h``.

    Array functions on purpose: 8 words times 7 tests written out as expressions
    make one generated method too long for the JIT compiler.
    """
    pairs = F.array(
        *[F.struct(F.lit(a).cast("bigint").alias("a"), F.lit(b).cast("bigint").alias("b"))
          for a, b in coefficients(hashes, seed)]
    )
    indexes = F.array(*[F.lit(j).cast("bigint") for j in range(bits // 64)])
    one, none, size = (F.lit(v).cast("bigint") for v in (1, 0, bits))

    def bit(p: Column, j: Column) -> Column:
        here = F.shiftright(p, 6) == j
        return F.when(here, F.call_function("shiftleft", one, p.bitwiseAND(F.lit(63)).cast("int"))).otherwise(none)

    def positions(x: Column) -> Column:
        return F.transform(pairs, lambda p: F.pmod(p["a"] * x + p["b"], size))

    def words(ps: Column) -> Column:
        return F.transform(indexes, lambda j: F.aggregate(ps, none, lambda acc, p: acc.bitwiseOR(bit(p, j))))

    # one-element arrays bind the hash, then the positions, so each is computed once
    return F.transform(F.transform(F.array(h), positions), words)[0]


def digit_has(digits: Column, position: Column) -> Column:
    """Whether the bit at ``position`` is set in a filter given as hex text of its bytes.

    Bytes cut off at the end read as zero.
    """
    low_half = position.bitwiseAND(F.lit(4)) == 0
    at = F.shiftright(position, 3) * 2 + F.when(low_half, 2).otherwise(1)
    digit = F.substr(digits, at.cast("int"), F.lit(1))
    value = F.when(digit == "", 0).otherwise(F.call_function("instr", F.lit("0123456789ABCDEF"), digit) - 1)
    return F.call_function("shiftright", value, position.bitwiseAND(F.lit(3)).cast("int")).bitwiseAND(F.lit(1)) == 1


def words_to_text(words: Sequence[Column]) -> Column:
    """Base64 text of a filter given as words (NULL words count as empty)."""
    big_endian = [F.lpad(F.hex(F.coalesce(w, F.lit(0).cast("bigint"))), 16, "0") for w in words]
    little = [
        F.concat(*[F.substring(word, 15 - 2 * byte, 2) for byte in range(8)]) for word in big_endian
    ]
    trimmed = F.regexp_replace(F.concat(*little), "^((?:..)*?)(?:00)+$", "$1")
    return F.regexp_replace(F.base64(F.unhex(trimmed)), "[\r\n]", "")


def text_to_words(text: Column, bits: int) -> list[Column]:
    """The words of a Base64 filter; NULL and empty text give zero words."""
    padded = F.rpad(F.hex(F.unbase64(F.coalesce(text, F.lit("")))), bits // 4, "0")

    def word(j: int) -> Column:
        swapped = F.concat(*[F.substring(padded, 16 * j + 15 - 2 * byte, 2) for byte in range(8)])
        high = F.conv(F.substring(swapped, 1, 8), 16, 10).cast("bigint")
        low = F.conv(F.substring(swapped, 9, 8), 16, 10).cast("bigint")
        return F.shiftleft(high, 32).bitwiseOR(low)

    return [word(j) for j in range(bits // 64)]
