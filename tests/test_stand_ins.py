import pytest
from pyspark.sql import functions as F

from checks import queries
from tallymill.functions import ids
from tallymill.operators import sets
from tallymill.plans import stand_ins
from tests.conftest import SMALL, plan_of

ROWS = 200


@pytest.fixture
def small_tasks(monkeypatch):
    monkeypatch.setattr(stand_ins, "ROWS_PER_TASK", ROWS)


def most_in_a_task(frame):
    return frame.groupBy(F.spark_partition_id().alias("task")).count().agg(F.max("count")).first()[0]


@pytest.mark.parametrize("view", [stand_ins.purchases, stand_ins.ratings, stand_ins.planted_ratings])
def test_tasks_do_not_grow_with_the_table(spark, view, small_tasks):
    """Also where the setting for shuffles is low, and however few bytes a row takes."""
    assert most_in_a_task(view(spark, SMALL)) < 2 * ROWS


def test_pairs_are_dealt_once(spark, small_tasks):
    plan = plan_of(sets.dedupe_any(stand_ins.purchases(spark, SMALL, 9), ["o_custkey", "l_partkey"], 9))
    above = plan.split("Join")[0]
    assert above.count("Exchange") == 1 and "hashpartitioning(o_custkey" in above and ", 9), REPARTITION_BY_NUM" in above


def test_dedupe_any_with_partitions(spark):
    frame = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "d"), (None, "e")], "k int, v string")
    kept = sets.dedupe_any(frame, ["k"], 3)
    assert kept.count() == 3 and kept.columns == ["k", "v"]


@pytest.mark.parametrize("query, operator", [("unique_id", "with_unique_id"), ("unique_id_prepended", "prepend_unique_id")])
def test_ids_are_given_by_tasks_of_bounded_size(spark, monkeypatch, small_tasks, query, operator):
    given, numbered = [], getattr(ids, operator)

    def seen(frame, *rest, **named):
        given.append(most_in_a_task(frame))
        return numbered(frame, *rest, **named)

    monkeypatch.setattr(ids, operator, seen)
    row = queries.QUERIES[query](spark, SMALL).first()
    assert row["rows"] == row["ids"] == spark.read.parquet(f"{SMALL}/lineitem.parquet").count() and row["negative"] == 0
    assert given[0] < 2 * ROWS
