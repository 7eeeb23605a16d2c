"""Blocked Bloom filters: a key sets a few bits of one 64-bit block."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BITS_SET = 4


def filter_block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks)).cast("int")


def filter_bits(key: Column) -> Column:
    """The bits of a key within its block, from a second hash."""
    bits = F.xxhash64(key, F.lit(1))
    mask = F.lit(0).cast("long")
    for place in range(BITS_SET):
        six = F.shiftright(bits, 6 * place).bitwiseAND(F.lit(63)).cast("int")
        mask = mask.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), six))
    return mask
