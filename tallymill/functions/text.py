"""Text forms of values that a text sink cannot hold."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def stringify_array(values: Column) -> Column:
    """``[a,b,c]``; null elements print as ``null``, a null array stays null."""
    printed = F.transform(values, lambda value: F.coalesce(value.cast("string"), F.lit("null")))
    return F.when(
        values.isNotNull(), F.concat(F.lit("["), F.concat_ws(",", printed), F.lit("]"))
    )
