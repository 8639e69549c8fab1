import math

import pytest
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.sql import functions as F

from tallymill.functions import ids, metrics
from tallymill.functions.hashing import hash_bucket
from tallymill.functions.text import stringify_array
from tallymill.operators.sampling import with_split
from tallymill.plans import stand_ins
from tests.conftest import MEDIUM, SMALL


def test_buckets_match_the_published_check_values(spark):
    ratings = stand_ins.ratings(spark, MEDIUM)
    bucket = hash_bucket(42, "userId", "movieId")
    found = ratings.withColumn("b", bucket).agg(
        F.sum("b"), F.count_if(F.col("b") < 80), F.count_if(F.col("b") < 5)
    ).first()
    assert tuple(found) == (2_947_095, 47_501, 2_817)


def test_baseline_matches_the_published_value(spark):
    ratings = stand_ins.ratings(spark, MEDIUM)
    labelled = with_split(ratings, {"train": 0.8, "validation": 0.1, "test": 0.1}, ["userId", "movieId"])
    train = labelled.where(F.col("split") == "train")
    test = labelled.where(F.col("split") == "test")
    separate = metrics.baseline_rmse(train, test).first()[0]
    single = metrics.split_baseline_rmse(labelled).first()["baseline_rmse"]
    assert separate == pytest.approx(1.440516, abs=1e-6)
    assert single == pytest.approx(separate, abs=1e-12)


def test_rmse_equals_the_library_evaluator(spark):
    frame = spark.createDataFrame([(1.0, 1.5), (2.0, 0.0), (4.5, 4.5)], "rating float, prediction double")
    ours = frame.agg(metrics.rmse(F.col("rating"), F.col("prediction"))).first()[0]
    theirs = RegressionEvaluator(metricName="rmse", labelCol="rating").evaluate(frame)
    assert ours == pytest.approx(theirs) and ours == pytest.approx(math.sqrt(4.25 / 3))


def test_metrics_of_nothing_are_null(spark):
    empty = spark.createDataFrame([], "rating float, prediction double")
    assert empty.agg(metrics.rmse(F.col("rating"), F.col("prediction"))).first()[0] is None
    assert metrics.baseline_rmse(empty, empty).first()[0] is None


def test_baseline_needs_no_join(spark):
    frame = spark.range(5).select(F.col("id").cast("float").alias("rating"))
    plan = metrics.baseline_rmse(frame, frame)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "CartesianProduct" not in plan


@pytest.mark.parametrize("base, value, expected", [(2.0, 1.5, 25.0), (1.0, 2.0, -100.0), (0.0, 1.0, None)])
def test_improvement(spark, base, value, expected):
    column = metrics.improvement_percent(F.lit(base), F.lit(value))
    assert spark.range(1).select(column).first()[0] == expected


def test_stringify(spark):
    frame = spark.createDataFrame(
        [(["a", "b"],), ([],), (None,), (["x", None, ""],)], "v array<string>"
    )
    found = [row[0] for row in frame.select(stringify_array(F.col("v"))).collect()]
    assert found == ["[a,b]", "[]", None, "[x,null,]"]
    numbers = spark.sql("select array(1, 2) as v").select(stringify_array(F.col("v")))
    assert numbers.first()[0] == "[1,2]"


def test_unique_id_grows(spark):
    found = [row[0] for row in ids.with_unique_id(spark.range(0, 100, 1, 7)).select("unique_id").collect()]
    assert len(set(found)) == 100 and found == sorted(found)


@pytest.mark.parametrize("partitions", [1, 3, 7])
def test_prepended_id_equals_the_rdd_operation(spark, partitions):
    frame = spark.range(0, 50, 1, partitions).withColumnRenamed("id", "v")
    numbered = ids.prepend_unique_id(frame)
    assert numbered.columns == ["id", "v"]
    expected = {row[0]: number for row, number in frame.rdd.zipWithUniqueId().collect()}
    assert {row["v"]: row["id"] for row in numbered.collect()} == expected


def test_prepended_id_is_unique_on_shuffled_frames(spark):
    orders = spark.read.parquet(f"{SMALL}/orders.parquet")
    grouped = orders.groupBy("o_custkey").count()
    for stride in (None, 2, 5):
        numbered = ids.prepend_unique_id(grouped, stride=stride)
        assert numbered.select("id").distinct().count() == grouped.count()
