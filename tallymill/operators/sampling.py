"""Sampling and splitting."""

from __future__ import annotations

from fractions import Fraction
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallymill.functions.hashing import digest_number, hash_bucket, key_digest

DEFAULT_SEED = 42
MAX_LARGE_STRATA = 100_000

# Helper columns, gone from the results.
_DIGEST, _RANK, _SIZE, _LIMIT, _PARTS = "__digest", "__rank", "__size", "__limit", "__parts"
_SLICE, _SLICE_SIZE, _LEFT = "__slice", "__slice_size", "__left"


def sample_by_fractions(
    df: DataFrame, column: str, fractions: dict, seed: int = DEFAULT_SEED
) -> DataFrame:
    """Stratified Bernoulli sample with a fraction per stratum, for a handful of strata.

    Strata that are not listed are dropped. The outcome depends on the partitioning.
    """
    return df.sampleBy(column, fractions, seed)


def stratified_sample(
    df: DataFrame,
    stratum: str,
    fraction: float,
    keys: Sequence[str],
    seed: int | str = DEFAULT_SEED,
    buckets: int = 10_000,
) -> DataFrame:
    """Every stratum keeps each of its rows with the same probability; null strata are dropped.

    With one fraction for all strata a row's fate does not depend on its stratum, so there is no
    map of strata, no shuffle, and the whole sample is a filter on the scan.
    """
    _check_fraction(fraction)
    bound = round(fraction * buckets)
    if abs(bound - fraction * buckets) > 1e-6:
        raise ValueError(f"{buckets} buckets are too coarse for the fraction {fraction}")
    kept = hash_bucket(seed, *keys, buckets=buckets) < bound
    return df.where(F.col(stratum).isNotNull() & kept)


def stratified_sample_exact(
    df: DataFrame,
    stratum: str,
    fraction: float,
    keys: Sequence[str],
    seed: int | str = DEFAULT_SEED,
    rows_per_slice: int = 1_000_000,
) -> DataFrame:
    """Exactly ``ceil(fraction * n)`` rows of every stratum with ``n`` rows: those of lowest digest.

    Ordinary strata are counted and ranked in one window. A large stratum would make one huge task,
    so it is cut into slices of the digest range. The counts of the slices tell which are kept
    whole, which are dropped, and which single one the quota ends in; only that one is ranked.

    A stratum is large above ``rows_per_slice`` rows and above one ``MAX_LARGE_STRATA``-th of all
    rows. The second condition bounds the number of large strata, and twice that the number of
    their slices, whatever the size of the input; so both tables may be broadcast.
    """
    _check_fraction(fraction)
    rows = df.where(F.col(stratum).isNotNull()).withColumn(_DIGEST, key_digest(seed, *keys))
    order = [F.col(_DIGEST), *[F.col(key) for key in keys]]

    sizes = rows.groupBy(stratum).agg(F.count("*").alias(_SIZE))
    share = sizes.agg((F.sum(_SIZE) / MAX_LARGE_STRATA).alias("share")).scalar()
    large = (
        sizes.withColumn(_LIMIT, F.greatest(F.lit(float(rows_per_slice)), share))
        .where(F.col(_SIZE) > F.col(_LIMIT))
        .withColumn(_PARTS, F.ceil(F.col(_SIZE) / F.col(_LIMIT)))
        .select(stratum, _SIZE, _PARTS)
    )

    members = Window.partitionBy(stratum)
    ordinary = (
        rows.join(F.broadcast(large.select(stratum)), stratum, "left_anti")
        .withColumn(_RANK, F.row_number().over(members.orderBy(*order)))
        .withColumn(_SIZE, F.count("*").over(members))
        .where(F.col(_RANK) <= _quota(fraction, F.col(_SIZE)))
    )

    sliced = rows.join(F.broadcast(large), stratum).withColumn(
        _SLICE, F.shiftright(digest_number(F.col(_DIGEST)) * F.col(_PARTS), 32)
    )
    earlier = Window.partitionBy(stratum).orderBy(_SLICE).rowsBetween(Window.unboundedPreceding, -1)
    open_slices = (
        sliced.groupBy(stratum, _SLICE, _SIZE)
        .agg(F.count("*").alias(_SLICE_SIZE))
        .withColumn(
            _LEFT,
            _quota(fraction, F.col(_SIZE)) - F.coalesce(F.sum(_SLICE_SIZE).over(earlier), F.lit(0)),
        )
        .where(F.col(_LEFT) > 0)
        .select(stratum, _SLICE, _SLICE_SIZE, _LEFT)
    )
    candidates = sliced.join(F.broadcast(open_slices), [stratum, _SLICE])
    whole = candidates.where(F.col(_SLICE_SIZE) <= F.col(_LEFT))
    partly = (
        candidates.where(F.col(_SLICE_SIZE) > F.col(_LEFT))
        .withColumn(_RANK, F.row_number().over(Window.partitionBy(stratum, _SLICE).orderBy(*order)))
        .where(F.col(_RANK) <= F.col(_LEFT))
    )
    result = ordinary.select(*df.columns)
    for part in (whole, partly):
        result = result.unionByName(part.select(*df.columns))
    return result


def random_split(
    df: DataFrame, weights: Sequence[float], seed: int = DEFAULT_SEED
) -> list[DataFrame]:
    """Spark's own split; depends on the partitioning and the order of the rows."""
    return df.randomSplit(list(weights), seed)


def split_bounds(weights: Sequence[float], buckets: int = 100) -> list[int]:
    """Upper bucket bound of every part."""
    total = float(sum(weights))
    if total <= 0 or any(weight <= 0 for weight in weights):
        raise ValueError("weights must be positive")
    bounds, reached = [], 0.0
    for weight in weights:
        reached += weight
        bounds.append(round(reached / total * buckets))
    if len({0, *bounds}) != len(bounds) + 1:
        raise ValueError(f"{buckets} buckets are too coarse for the weights {list(weights)}")
    return bounds


def with_split(
    df: DataFrame,
    weights: dict[str, float],
    keys: Sequence[str],
    seed: int | str = DEFAULT_SEED,
    buckets: int = 100,
    name: str = "split",
) -> DataFrame:
    """Label every row with its part. Rows with equal keys share a part."""
    labels = list(weights)
    bounds = split_bounds(list(weights.values()), buckets)
    bucket = hash_bucket(seed, *keys, buckets=buckets)
    label: Column = F.lit(labels[-1])
    for text, bound in reversed(list(zip(labels[:-1], bounds[:-1]))):
        label = F.when(bucket < bound, F.lit(text)).otherwise(label)
    return df.withColumn(name, label)


def hash_split(
    df: DataFrame,
    weights: Sequence[float],
    keys: Sequence[str],
    seed: int | str = DEFAULT_SEED,
    buckets: int = 100,
) -> list[DataFrame]:
    """The parts as separate frames: disjoint, complete, and independent of the partitioning."""
    bounds = [0, *split_bounds(weights, buckets)]
    bucket = hash_bucket(seed, *keys, buckets=buckets)
    return [df.where((bucket >= low) & (bucket < high)) for low, high in zip(bounds, bounds[1:])]


def _quota(fraction: float, size: Column) -> Column:
    # Integer arithmetic: 0.05 * 20 must not round up to 2, nor the smallest share of a row down to 0.
    share = Fraction(str(fraction))
    above, below = (F.lit(str(part)).cast("decimal(19,0)") for part in (share.numerator, share.denominator))
    product = (above * size.cast("decimal(18,0)")).cast("decimal(38,0)")
    return F.call_function("div", product + below - 1, below).cast("bigint")


def _check_fraction(fraction: float) -> None:
    if not 0 <= fraction <= 1:
        raise ValueError(f"fraction must lie between 0 and 1, not {fraction}")
