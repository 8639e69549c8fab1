"""Joins used as lookups, set difference, and de-duplication."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymill.operators.ranking import first_per_group

_KEY, _ROW = "__key", "__row"


def inner_lookup(left: DataFrame, right: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """Inner equi-join; both keys are kept, or one of them if their names are the same.

    The right side is joined under names of its own, so that both frames may come from the same one. No broadcast is forced: adaptive execution picks it from the measured size of the right side,
    and splits the partitions of a hot key otherwise.
    """
    columns = [name for name in right.columns if name != right_key or left_key != right_key]
    packed = right.select(F.col(right_key).alias(_KEY), F.struct(*columns, F.lit(0).alias(_KEY)).alias(_ROW))
    joined = left.join(packed, F.col(left_key) == F.col(_KEY), "inner")
    return joined.select(*left.columns, *[F.col(_ROW)[name].alias(name) for name in columns])


def subtract_rows(left: DataFrame, right: DataFrame) -> DataFrame:
    """Distinct rows of ``left`` that do not occur in ``right``; nulls count as equal."""
    return left.subtract(right)


def exclude_keys(df: DataFrame, others: DataFrame, keys: dict[str, str] | Sequence[str]) -> DataFrame:
    """Rows of ``df`` whose key does not occur in ``others``; rows with a null key stay.

    ``keys`` names the shared key columns, or maps ``df``'s names to those of ``others``.
    An equi anti-join: it never turns into a cross product, and it does not de-duplicate.
    """
    pairs = dict(keys) if isinstance(keys, dict) else {key: key for key in keys}
    named = others.select(*[F.col(theirs).alias(f"{_KEY}{place}") for place, theirs in enumerate(pairs.values())])
    condition = [F.col(mine) == F.col(f"{_KEY}{place}") for place, mine in enumerate(pairs)]
    return df.join(named, condition, "left_anti")


def distinct_values(df: DataFrame, *columns: str) -> DataFrame:
    return df.select(*columns).distinct() if columns else df.distinct()


def dedupe_any(df: DataFrame, keys: Sequence[str], partitions: int | None = None) -> DataFrame:
    """One row per key; which one is open.

    With nearly as many keys as rows it pays to deal the rows by key first, to so many ``partitions``: tasks before
    the shuffle would keep a table of all their keys and drop next to nothing.
    """
    dealt = df if partitions is None else df.repartition(partitions, *keys)
    return dealt.dropDuplicates(list(keys))


def dedupe_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """One row per key: the first in ``order``."""
    columns = [F.col(term) if isinstance(term, str) else term for term in order]
    return first_per_group(df, keys, columns)
