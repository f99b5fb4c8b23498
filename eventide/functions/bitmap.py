"""The per-user bit offset of the one-hash distinct-visitor bitmap.

offset = fold over the characters of the decimal user id of
``h = h * seed + code(char)``, reduced to ``cap`` bits.  Masking at every step
is equal modulo 2**k to masking once at the end (wrapping 64-bit arithmetic),
and it never overflows, which matters under ANSI arithmetic.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from eventide.timeutil import col

# Bitmap size and hash seed of the surveyed job.
DEFAULT_CAP = 1 << 29
DEFAULT_SEED = 43


def bitmap_offset(user, cap: int = DEFAULT_CAP, seed: int = DEFAULT_SEED) -> Column:
    if cap <= 0 or cap & (cap - 1):
        raise ValueError("cap must be a power of two")
    mask = F.lit(cap - 1).cast("bigint")
    chars = F.split(col(user).cast("string"), "")
    return F.aggregate(chars, F.lit(0).cast("bigint"),
                       lambda acc, ch: (acc * seed + F.ascii(ch).cast("bigint")).bitwiseAND(mask))
