from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from tallymill.operators import caching, ranking, sets
from tests.conftest import plan_of, rows_of


@pytest.fixture
def trips(spark):
    rows = [("a", 1)] * 3 + [("b", 1)] * 3 + [("c", 2)] * 2 + [(None, 2)] * 4 + [("d", None)]
    return spark.createDataFrame(rows, "k string, n int")


def test_top_counts_breaks_ties_by_key(trips):
    found = [tuple(row) for row in ranking.top_counts(trips, ["k"], "total", limit=3).collect()]
    assert found == [(None, 4), ("a", 3), ("b", 3)]


def test_top_counts_ignores_null_in_the_condition(trips):
    found = [tuple(row) for row in ranking.top_counts(trips, ["k"], "total", F.col("n") >= 1).collect()]
    assert found == [(None, 4), ("a", 3), ("b", 3), ("c", 2)]


def test_top_counts_of_nothing(trips):
    assert ranking.top_counts(trips.where("false"), ["k"], "total").collect() == []


def test_top_counts_plan(trips):
    plan = plan_of(ranking.top_counts(trips, ["k"], "total"))
    assert "TakeOrderedAndProject" in plan and "partial_count" in plan


def _brute_force(rows, k):
    best = {}
    for group, item, value in rows:
        best.setdefault(group, []).append((-value, item))
    return sorted(
        (group, item, -value) for group, found in best.items() for value, item in sorted(found)[:k]
    )


@pytest.mark.parametrize("k", [1, 3, 40])
@pytest.mark.parametrize("threshold", ["1000", "2"])
def test_top_k_per_group(spark, setting, k, threshold):
    # One group holds a third of all rows; scores repeat, and so do rows of the hot group.
    setting("spark.sql.optimizer.windowGroupLimitThreshold", threshold)
    rows = [(number % 9 if number % 3 else 0, number % 500, number % 7) for number in range(1500)]
    frame = spark.createDataFrame(rows, "g int, item int, score int").repartition(5)
    found = ranking.top_k_per_group(frame, ["g"], "score", ["item"], k)
    assert found.columns == ["g", "item", "score"]
    assert sorted(tuple(row) for row in found.collect()) == _brute_force(rows, k)


def test_groups_are_cut_before_the_shuffle(spark, setting):
    frame = spark.range(100).selectExpr("id % 3 as g", "id as item", "id as score")
    plan = plan_of(ranking.top_k_per_group(frame, ["g"], "score", ["item"], 5))
    assert plan.count("WindowGroupLimit") == 2 and "Partial" in plan
    setting("spark.sql.optimizer.windowGroupLimitThreshold", "2")
    salted = plan_of(ranking.top_k_per_group(frame, ["g"], "score", ["item"], 5))
    assert salted.count("row_number()") >= 2


def test_rank_name_is_kept(spark):
    frame = spark.createDataFrame([(1, 5, 1.0), (1, 6, 2.0)], "g int, item int, score double")
    found = ranking.top_k_per_group(frame, ["g"], "score", ["item"], 2, rank_name="place")
    assert rows_of(found.select("item", "place")) == [(5, 2), (6, 1)]


def test_full_sort(spark):
    frame = spark.createDataFrame([(3, 1.0), (1, None), (2, 1.0), (4, 9.0)], "item int, score double")
    assert [row[0] for row in ranking.rank_by(frame, "score", "item").collect()] == [4, 2, 3, 1]


def test_nest_and_flatten(spark):
    rows = [(1, item, float(item % 4)) for item in range(10)] + [(2, 7, 1.0)]
    frame = spark.createDataFrame(rows, "userId int, movieId int, rating float")
    nested = ranking.nest_top_k(frame, "userId", "movieId", "rating", 3)
    assert nested.schema["recommendations"].dataType.simpleString() == "array<struct<movieId:int,rating:float>>"
    first = nested.where("userId = 1").first()["recommendations"]
    assert [tuple(entry) for entry in first] == [(3, 3.0), (7, 3.0), (2, 2.0)]
    flat = ranking.flatten_nested(nested, "userId", "movieId", "rating")
    assert rows_of(flat) == [(1, 2, 2.0), (1, 3, 3.0), (1, 7, 3.0), (2, 7, 1.0)]


def test_flatten_drops_empty_and_null(spark):
    frame = spark.sql(
        """select 1 as u, array(named_struct('i', 5, 's', 1.0)) as recommendations
           union all select 2, cast(array() as array<struct<i:int,s:decimal(2,1)>>)
           union all select 3, null"""
    )
    assert [row["u"] for row in ranking.flatten_nested(frame, "u", "i", "s").collect()] == [1]


def test_subtract_is_distinct_and_null_safe(spark):
    left = spark.createDataFrame([(1, None), (1, None), (2, "x"), (2, "x"), (3, "y")], "a int, b string")
    right = spark.createDataFrame([(1, None), (3, "z")], "a int, b string")
    assert rows_of(sets.subtract_rows(left, right)) == [(2, "x"), (3, "y")]


def test_exclude_keys_keeps_duplicates_and_null_keys(spark):
    left = spark.createDataFrame([(1,), (2,), (2,), (None,)], "a int")
    right = spark.createDataFrame([(1,), (None,)], "b int")
    assert rows_of(sets.exclude_keys(left, right, {"a": "b"})) == [(2,), (2,), (None,)]


def test_exclude_keys_on_pairs_ignores_the_rating(spark):
    recommended = spark.createDataFrame([(1, 10, 4.9), (1, 11, 4.8)], "userId int, movieId int, rating float")
    rated = spark.createDataFrame([(1, 10, 4.0), (2, 11, 3.0)], "userId int, movieId int, rating float")
    left = sets.exclude_keys(recommended, rated, ["userId", "movieId"])
    assert [row["movieId"] for row in left.collect()] == [11]
    # The difference of whole rows would have removed nothing.
    assert sets.subtract_rows(recommended, rated).count() == 2


def test_exclusion_never_becomes_a_product(spark, setting):
    setting("spark.sql.autoBroadcastJoinThreshold", "-1")
    left = spark.range(10).withColumnRenamed("id", "a")
    plan = plan_of(sets.exclude_keys(left, spark.range(5), {"a": "id"}))
    assert "LeftAnti" in plan and "NestedLoop" not in plan and "Cartesian" not in plan


def test_lookup(spark):
    left = spark.createDataFrame([(1, 10), (1, 99), (1, None)], "userId int, movieId int")
    right = spark.createDataFrame([(10, "t"), (None, "n")], "id int, title string")
    assert rows_of(sets.inner_lookup(left, right, "movieId", "id")) == [(1, 10, 10, "t")]


def test_dedupe(spark):
    frame = spark.createDataFrame([(1, "b"), (1, "a"), (2, "c"), (None, "d"), (None, "e")], "k int, v string")
    assert rows_of(sets.dedupe_first(frame, ["k"], ["v"])) == [(1, "a"), (2, "c"), (None, "d")]
    assert rows_of(sets.dedupe_first(frame, ["k"], [F.desc("v")])) == [(1, "b"), (2, "c"), (None, "e")]
    assert sets.dedupe_any(frame, ["k"]).count() == 3
    assert rows_of(sets.distinct_values(frame, "k")) == [(1,), (2,), (None,)]
    assert sets.distinct_values(frame.union(frame)).count() == 5


@pytest.mark.parametrize("partitions, left", [(1, 1), (2, 1), (3, 1), (4, 2), (32, 21), (33, 21)])
def test_shrunk_partitions(partitions, left):
    assert caching.shrunk_partitions(partitions) == left


def test_shrunk_partitions_for_other_shares():
    assert caching.shrunk_partitions(100, Fraction(9, 10)) == 9


def test_coalesce_after_filter(spark):
    scan = spark.range(0, 100, 1, 9)
    shrunk = caching.coalesce_after_filter(scan.where("id > 50"), scan)
    assert shrunk.rdd.getNumPartitions() == 5 and shrunk.count() == 49
    assert "Exchange" not in plan_of(shrunk)
    with pytest.raises(ValueError):
        caching.coalesce_after_filter(scan)


def test_persisted_frames_are_released(spark):
    frame = spark.range(10)
    with pytest.raises(RuntimeError):
        with caching.persisted(frame):
            assert frame.storageLevel.useMemory and frame.storageLevel.useDisk
            assert "InMemoryTableScan" in plan_of(frame.where("id > 3"))
            raise RuntimeError
    assert not frame.storageLevel.useMemory


def test_lookups_on_a_common_lineage(spark):
    frame = spark.createDataFrame([(1, 2), (2, 3), (5, 5), (None, 1)], "a int, b int")
    part = frame.where("a < 3")
    assert rows_of(sets.exclude_keys(frame, part, {"a": "b"})) == rows_of(frame.where("a IS NULL OR a IN (1, 5)"))
    assert rows_of(sets.exclude_keys(frame, part, ["a"])) == rows_of(frame.where("a IS NULL OR a = 5"))
    assert rows_of(sets.inner_lookup(frame, part, "a", "b")) == [(2, 3, 1, 2)]
    same = sets.inner_lookup(frame, part, "a", "a")
    assert same.columns == ["a", "b", "b"] and rows_of(same) == [(1, 2, 2), (2, 3, 3)]


def test_long_lists_per_group_may_hold_maps(spark):
    frame = spark.range(2500).selectExpr("id % 2 AS g", "id", "map('k', id) AS m")
    best = ranking.first_per_group(frame, ["g"], [F.desc("id")], 1001)
    assert best.groupBy("g").count().collect()[0]["count"] == 1001 and best.agg(F.min("id")).first()[0] == 498
