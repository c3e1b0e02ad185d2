"""The polynomial string hash behind the one-hash bitmap."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Multiplier of the hash and the bitmap capacity in bits.
HASH_BASE = 31
BITMAP_BITS = 1 << 29


def bitmap_offset(value: Column, bits: int = BITMAP_BITS) -> Column:
    """Bit position of a value: its decimal text folded with base 31, kept inside ``bits``.

    ``bits`` is a power of two.  Masking at every step gives the same low bits as masking once
    at the end, and cannot overflow.
    """
    letters = F.split(value.cast("string"), "")
    return F.aggregate(
        letters,
        F.lit(0).cast("long"),
        lambda acc, ch: (acc * HASH_BASE + F.ascii(ch)).bitwiseAND(F.lit(bits - 1).cast("long")),
    )
