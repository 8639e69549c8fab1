import numpy as np
import pytest
from pyspark.sql import functions as F

from tallymill.plans import audit, recommender, stand_ins
from tests.conftest import SMALL, plan_of, rows_of


@pytest.fixture(scope="module")
def ratings(spark):
    return stand_ins.planted_ratings(spark, SMALL).cache()


@pytest.fixture(scope="module")
def model(ratings):
    als = recommender.make_als(max_iter=4, blocks=3, regParam=0.1)
    return recommender.fit(als, ratings, {als.rank: 4})


@pytest.fixture(scope="module")
def lists(model, ratings):
    return recommender.recommend_unrated(model, ratings, 10).cache()


def all_pairs(model, lists, ratings, k, tolerance=audit.TOLERANCE):
    """The rows of :func:`audit.better_left_out` from the scores of all pairs."""
    users = {row["id"]: np.array(row["features"]) for row in model.userFactors.collect()}
    items = {row["id"]: np.array(row["features"]) for row in model.itemFactors.collect()}
    listed, rated = {}, {}
    for user, item, rating in lists.collect():
        listed.setdefault(user, {})[item] = rating
    for row in ratings.collect():
        rated.setdefault(row["userId"], set()).add(row["movieId"])
    missing = set()
    for user, own in users.items():
        held = listed.get(user, {})
        least = min(held.values()) + tolerance if len(held) >= k else -np.inf
        missing |= {
            (user, item)
            for item, other in items.items()
            if own @ other > least and item not in held and item not in rated.get(user, ())
        }
    return missing


def pairs(frame):
    return {(row["userId"], row["movieId"]) for row in frame.collect()}


@pytest.mark.parametrize("block_items", [None, 37])
def test_right_lists_pass(model, ratings, lists, block_items):
    assert pairs(audit.better_left_out(model, lists, 10, ratings, block_items=block_items)) == all_pairs(model, lists, ratings, 10) == set()
    everything = rows_of(audit.totals(audit.audited(model, lists, 10, ratings)))
    assert everything == [(model.userFactors.count(), lists.count(), 0, 0, 0, 0)]


@pytest.mark.parametrize("block_items", [None, 37])
def test_what_was_left_out_is_found(model, ratings, lists, block_items):
    """Lists without their best item, cut short, missing, or filled up with items from elsewhere."""
    worse = lists.where("(userId + movieId) % 4 <> 0 AND userId <> 7")
    found = pairs(audit.better_left_out(model, worse, 10, ratings, block_items=block_items))
    assert found == all_pairs(model, worse, ratings, 10) and found
    assert {item for user, item in found if user == 7} == {
        row["id"] for row in model.itemFactors.collect()
    } - {row["movieId"] for row in ratings.where("userId = 7").collect()}
    # Without a k what is listed is compared alone.
    alone = pairs(audit.better_left_out(model, worse, None, ratings, block_items=block_items))
    listed = {row["userId"] for row in worse.collect()}
    assert alone == {pair for pair in all_pairs(model, worse, ratings, 1) if pair[0] in listed}


def test_faults_are_counted(spark, model, ratings, lists):
    user = lists.orderBy("userId").first()["userId"]
    own = lists.where(F.col("userId") == user).orderBy(F.desc("rating")).collect()
    rated = ratings.where(F.col("userId") == user).first()["movieId"]
    rows = [tuple(own[1]), tuple(own[1]), (user, own[2]["movieId"], own[2]["rating"] - 1), (user, rated, 0.0), (user, 999_999, 9.0)]
    broken = spark.createDataFrame(rows, lists.schema)
    row = audit.audited(model, broken, 5, ratings, users=broken).first()
    # A wrong score lowers the bound, so more counts as left out.
    assert row["userId"] == user and row["items"] == 5 and row["repeated"] == 1 and row["excluded"] == 1 and row["wrong"] == 3
    assert row["left_out"] >= 1


def test_users_without_long_vectors(model):
    """Zero vectors reach no positive aim, and all items are above a negative one."""
    users, aims = np.array([1, 2, 3, 4]), np.array([0.5, -0.5, -np.inf, 0.0])
    own = np.zeros((4, 2), np.float32)
    ids, factors = np.array([5, 6]), np.array([[1, 0], [0, 0]], np.float32)
    found = [(int(u), int(i)) for us, its, _ in audit._better_items(users, aims, own, ids, factors) for u, i in zip(us, its)]
    assert sorted(found) == [(2, 5), (2, 6), (3, 5), (3, 6)]


def test_bounds_rule_nothing_out_that_counts():
    rng = np.random.default_rng(3)
    factors = rng.normal(size=(5000, 8)).astype(np.float32) * rng.uniform(0.01, 1, (5000, 1)).astype(np.float32) ** 4
    own = rng.normal(size=(50, 8)).astype(np.float32)
    exact = own.astype(float) @ factors.astype(float).T
    # Between two scores, so that rounding decides nothing.
    aims = np.sort(exact, axis=1)[:, -27:-25].mean(axis=1)
    found = {(int(u), int(i)) for us, its, _ in audit._better_items(np.arange(50), aims, own, np.arange(5000), factors) for u, i in zip(us, its)}
    assert found == {(u, int(i)) for u in range(50) for i in np.flatnonzero(exact[u] > aims[u])}


def test_no_pairs_are_made_by_the_plan(model, ratings, lists, setting):
    setting("spark.sql.autoBroadcastJoinThreshold", "-1")
    plan = plan_of(audit.audited(model, lists, 10, ratings))
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_empty_lists(spark, model, ratings):
    none = spark.createDataFrame([], "userId int, movieId int, rating float")
    assert audit.audited(model, none, None, ratings).collect() == []
    nobody = audit.audited(model, none, 5, ratings, users=none)
    assert nobody.collect() == []
