"""Hash-keyed randomness.

Everything random in the library is a function of ``md5(seed|key)``. A sample, split or synthetic value
therefore does not depend on how the rows are partitioned, on task retries, or on the number of executors.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

HASH_SPACE = float(1 << 32)


def key_hash(key: str | Column, seed: int) -> Column:
    """md5 of ``seed|key`` as 32 hex digits; sorting by it is a seeded shuffle of the keys."""
    key = F.col(key) if isinstance(key, str) else key
    return F.md5(F.concat_ws("|", F.lit(str(seed)), key.cast("string")))


def hash_number(digest: Column, digits: int = 8) -> Column:
    """First ``digits`` hex digits of a digest as a long (8 digits: 0 .. 2**32-1)."""
    return F.conv(F.substring(digest, 1, digits), 16, 10).cast("long")


def uniform(key: str | Column, seed: int) -> Column:
    """Double in [0, 1) that depends only on seed and key."""
    return hash_number(key_hash(key, seed)) / F.lit(HASH_SPACE)


def split_bucket(key: str | Column, seed: int) -> Column:
    """Bucket 0 .. 9999 used by the random split."""
    return F.pmod(hash_number(key_hash(key, seed)), F.lit(10000))
