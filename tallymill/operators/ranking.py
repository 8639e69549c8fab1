"""Counting, ordering and top-k."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_SALT = "__salt"
_RANK = "__rank"


def group_counts(
    df: DataFrame, keys: Sequence[str], count_name: str, where: Column | None = None
) -> DataFrame:
    """Rows per key. Counts are combined before the shuffle, so a hot key costs one row per task."""
    rows = df if where is None else df.where(where)
    return rows.groupBy(*keys).agg(F.count("*").alias(count_name))


def top_counts(
    df: DataFrame,
    keys: Sequence[str],
    count_name: str,
    where: Column | None = None,
    limit: int = 10,
) -> DataFrame:
    """The ``limit`` most frequent keys; equal counts are ordered by key."""
    order = [F.desc(count_name), *[F.asc_nulls_last(key) for key in keys]]
    return group_counts(df, keys, count_name, where).orderBy(*order).limit(limit)


def rank_by(df: DataFrame, score: str, *ties: str) -> DataFrame:
    """Full sort by descending score with a defined order among equal scores."""
    return df.orderBy(F.desc_nulls_last(score), *[F.asc(tie) for tie in ties])


def first_per_group(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    k: int = 1,
    rank_name: str | None = None,
) -> DataFrame:
    """First ``k`` rows of every group in the given order.

    ``order`` should be total, else the choice among equal rows is open. Up to the optimizer's
    group-limit threshold Spark cuts every group to ``k`` rows in each task before the shuffle,
    so that a hot group stays small. For larger ``k`` the same is done here by ranking within
    salted parts of the group first. The salt is a hash of the row and its input partition: equal
    rows spread out, and a retried task assigns the same salts.
    """
    session = df.sparkSession
    threshold = int(session.conf.get("spark.sql.optimizer.windowGroupLimitThreshold", "1000"))
    rank = rank_name or _RANK
    if k > threshold:
        parts = int(session.conf.get("spark.sql.shuffle.partitions"))
        # Maps cannot be hashed.
        hashed = [name for name, kind in df.dtypes if "map<" not in kind]
        salted = df.withColumn(_SALT, F.pmod(F.xxhash64(*hashed, F.spark_partition_id()), F.lit(parts)))
        within = Window.partitionBy(*keys, _SALT).orderBy(*order)
        # The repartition keeps Spark from reusing a placement by the group keys alone.
        df = (
            salted.repartition(*keys, _SALT)
            .withColumn(_RANK, F.row_number().over(within))
            .where(F.col(_RANK) <= k)
            .drop(_SALT, _RANK)
        )
    ranked = df.withColumn(rank, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    kept = ranked.where(F.col(rank) <= k)
    return kept if rank_name else kept.drop(rank)


def top_k_per_group(
    df: DataFrame,
    group: Sequence[str],
    score: str,
    ties: Sequence[str],
    k: int,
    rank_name: str | None = None,
) -> DataFrame:
    """The ``k`` highest scores of every group; equal scores are ordered by ``ties``."""
    order = [F.desc_nulls_last(score), *[F.asc(tie) for tie in ties]]
    return first_per_group(df, group, order, k, rank_name)


def nest_top_k(
    df: DataFrame, group: str, item: str, score: str, k: int, name: str = "recommendations"
) -> DataFrame:
    """One row per group with its top ``k`` as ``array<struct<item, score>>``, best first.

    Arrays hold at most ``k`` elements, whatever the size of the group.
    """
    best = top_k_per_group(df, [group], score, [item], k, rank_name=_RANK)
    collected = F.array_sort(F.collect_list(F.struct(_RANK, item, score)))
    plain = F.transform(collected, lambda entry: F.struct(entry[item].alias(item), entry[score].alias(score)))
    return best.groupBy(group).agg(plain.alias(name))


def flatten_nested(
    df: DataFrame, group: str, item: str, score: str, name: str = "recommendations"
) -> DataFrame:
    """One row per array element; groups with an empty or null array disappear."""
    exploded = df.select(group, F.explode(name).alias("entry"))
    return exploded.select(group, F.col(f"entry.{item}"), F.col(f"entry.{score}"))
