import hashlib
import math
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from tallymill.operators import sampling
from tests.conftest import plan_of, rows_of

KEYS = ["userId", "movieId"]


@pytest.fixture(scope="module")
def ratings(spark):
    """One user holds a third of the rows; some rows have no user."""
    rows = [(1, movie) for movie in range(400)]
    rows += [(2 + number % 90, number) for number in range(780)] + [(None, number) for number in range(20)]
    return spark.createDataFrame(rows, "userId int, movieId int").repartition(6).cache()


def exact(rows, fraction, seed):
    groups = {}
    for user, movie in rows:
        if user is not None:
            groups.setdefault(user, []).append((hashlib.md5(f"{seed}-{user}-{movie}".encode()).hexdigest(), movie))
    return sorted(
        (user, movie)
        for user, found in groups.items()
        for _, movie in sorted(found)[: math.ceil(Fraction(str(fraction)) * len(found))]
    )


@pytest.mark.parametrize("rows_per_slice", [1, 7, 60, 399, 400, 1_000_000])
@pytest.mark.parametrize("fraction", [0.0, 0.05, 0.5, 1.0])
def test_exact_sample_with_and_without_slices(ratings, rows_per_slice, fraction):
    expected = exact([tuple(row) for row in ratings.collect()], fraction, "s")
    found = sampling.stratified_sample_exact(ratings, "userId", fraction, KEYS, "s", rows_per_slice)
    assert sorted(tuple(row) for row in found.collect()) == expected


def test_exact_sample_bounds_the_large_strata(spark, ratings, monkeypatch):
    # With room for two large strata, only users above half of all rows would be cut into slices.
    monkeypatch.setattr(sampling, "MAX_LARGE_STRATA", 2)
    expected = exact([tuple(row) for row in ratings.collect()], 0.3, "s")
    found = sampling.stratified_sample_exact(ratings, "userId", 0.3, KEYS, "s", rows_per_slice=5)
    assert sorted(tuple(row) for row in found.collect()) == expected


def test_quota_is_computed_in_decimals(spark):
    frame = spark.range(20).select(F.lit(1).alias("userId"), F.col("id").alias("movieId"))
    assert sampling.stratified_sample_exact(frame, "userId", 0.05, KEYS).count() == 1
    frame = spark.range(100).select(F.lit(1).alias("userId"), F.col("id").alias("movieId"))
    assert sampling.stratified_sample_exact(frame, "userId", 0.07, KEYS).count() == 7


def test_hash_sample_is_a_filter(ratings):
    sample = sampling.stratified_sample(ratings, "userId", 0.25, KEYS)
    assert "Exchange" not in plan_of(sample).replace("InMemoryRelation", "").split("InMemoryTableScan")[0]
    share = sample.count() / 1180
    assert 0.2 < share < 0.3
    assert sample.where("userId is null").count() == 0
    assert rows_of(sample) == rows_of(sampling.stratified_sample(ratings.repartition(2), "userId", 0.25, KEYS))


def test_hash_sample_reaches_every_stratum_alike(ratings):
    sample = sampling.stratified_sample(ratings, "userId", 0.5, KEYS)
    assert abs(sample.where("userId = 1").count() - 200) < 60


@pytest.mark.parametrize("fraction", [-0.1, 1.1])
def test_bad_fraction(ratings, fraction):
    with pytest.raises(ValueError, match="fraction"):
        sampling.stratified_sample(ratings, "userId", fraction, KEYS)


def test_fraction_finer_than_the_buckets(ratings):
    with pytest.raises(ValueError, match="too coarse"):
        sampling.stratified_sample(ratings, "userId", 0.00001, KEYS)
    fine = sampling.stratified_sample(ratings, "userId", 0.00001, KEYS, buckets=100_000)
    assert fine.count() <= 3


def test_sample_by_fractions_drops_other_strata(ratings):
    sample = sampling.sample_by_fractions(ratings, "userId", {1: 0.5, 2: 1.0})
    users = {row["userId"] for row in sample.collect()}
    assert users == {1, 2}
    assert sample.where("userId = 2").count() == ratings.where("userId = 2").count()


def test_hash_split_is_disjoint_complete_and_stable(ratings):
    parts = sampling.hash_split(ratings, [0.8, 0.1, 0.1], KEYS)
    together = [row for part in parts for row in rows_of(part)]
    assert sorted(together, key=repr) == rows_of(ratings)
    assert 0.75 < parts[0].count() / 1200 < 0.85
    again = sampling.hash_split(ratings.repartition(3), [8, 1, 1], KEYS)
    assert [rows_of(part) for part in parts] == [rows_of(part) for part in again]


def test_labels_agree_with_the_parts(ratings):
    labelled = sampling.with_split(ratings, {"train": 0.9, "test": 0.1}, KEYS)
    parts = sampling.hash_split(ratings, [0.9, 0.1], KEYS)
    for name, part in zip(("train", "test"), parts):
        assert rows_of(labelled.where(F.col("split") == name).drop("split")) == rows_of(part)


def test_salts_are_independent(ratings):
    sample = sampling.stratified_sample(ratings, "userId", 0.3, KEYS, seed="sample-42")
    shares = {
        row["split"]: row["count"]
        for row in sampling.with_split(sample, {"train": 0.8, "test": 0.2}, KEYS).groupBy("split").count().collect()
    }
    assert shares["test"] > 0.1 * sum(shares.values())


def test_random_split_is_complete(ratings):
    assert sum(part.count() for part in sampling.random_split(ratings, [0.8, 0.1, 0.1])) == 1200


@pytest.mark.parametrize("weights", [[0.0, 1.0], [-1, 2], []])
def test_bad_weights(weights):
    with pytest.raises(ValueError):
        sampling.split_bounds(weights)


def test_weights_finer_than_the_buckets():
    assert sampling.split_bounds([0.8, 0.1, 0.1]) == [80, 90, 100]
    with pytest.raises(ValueError, match="too coarse"):
        sampling.split_bounds([0.999, 0.001])
    assert sampling.split_bounds([0.999, 0.001], buckets=1000) == [999, 1000]


@pytest.mark.parametrize(("fraction", "kept"), [(1e-11, 1), (1 / 3, 334), (0.05, 50), (0.0, 0), (1.0, 1000), (1e-3, 1)])
def test_quota_is_exact_for_any_fraction(spark, fraction, kept):
    frame = spark.range(1000).selectExpr("0 AS s", "id")
    assert sampling.stratified_sample_exact(frame, "s", fraction, ["id"]).count() == kept
