"""Reproducible per-row randomness.

``rand``-based sampling depends on the partitioning and the row order, so a task that is retried
after an executor is lost may decide differently. A hash of the row's key does not, and any SQL
engine with ``md5`` reproduces it.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def key_digest(salt: int | str, *keys: str) -> Column:
    """Hex md5 of the salt and the key columns, joined by ``-``."""
    return F.md5(F.concat_ws("-", F.lit(str(salt)), *[F.col(key).cast("string") for key in keys]))


def digest_number(digest: Column) -> Column:
    """First 32 bits of a digest as a bigint in 0 .. 2^32 - 1; keeps the digest's order."""
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")


def hash_bucket(salt: int | str, *keys: str, buckets: int = 100) -> Column:
    """Bucket 0 .. buckets - 1 of a row. Use a different salt for each purpose."""
    return F.pmod(digest_number(key_digest(salt, *keys)), F.lit(buckets)).cast("int")
