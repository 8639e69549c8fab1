"""Row ids."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# monotonically_increasing_id() keeps the partition index above the low 33 bits.
_ROW_BITS = 33


def with_unique_id(df: DataFrame, name: str = "unique_id") -> DataFrame:
    """Append a unique id that grows along the frame and has gaps between partitions."""
    return df.withColumn(name, F.monotonically_increasing_id())


def prepend_unique_id(df: DataFrame, name: str = "id", stride: int | None = None) -> DataFrame:
    """Put a unique id first: row ``i`` of partition ``k`` gets ``i * stride + k``.

    ``stride`` is the partition count. Counting the partitions of a frame that shuffles runs those
    shuffles under adaptive execution, so pass it where it is known. The frame is coalesced to
    ``stride`` partitions in either case, because the ids are unique only up to that many.
    """
    if stride is None:
        stride = max(1, df.rdd.getNumPartitions())
    generated = F.monotonically_increasing_id()
    row = generated.bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    partition = F.shiftright(generated, _ROW_BITS)
    return df.coalesce(stride).select((row * stride + partition).alias(name), "*")
