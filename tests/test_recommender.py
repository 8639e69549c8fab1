import numpy as np
import pytest
from pyspark.ml.recommendation import ALSModel
from pyspark.sql import functions as F

from tallymill.plans import recommender, stand_ins
from tests.conftest import SMALL, plan_of, rows_of


@pytest.fixture(scope="module")
def ratings(spark):
    return stand_ins.planted_ratings(spark, SMALL).cache()


@pytest.fixture(scope="module")
def movies(spark):
    return stand_ins.movies(spark, SMALL).cache()


@pytest.fixture(scope="module")
def model(ratings):
    als = recommender.make_als(max_iter=4, blocks=3, regParam=0.1)
    return recommender.fit(als, ratings, {als.rank: 4})


@pytest.fixture(scope="module")
def scores(model):
    """Every score of the model, by plain matrix multiplication."""
    users = {row["id"]: np.array(row["features"]) for row in model.userFactors.collect()}
    items = {row["id"]: np.array(row["features"]) for row in model.itemFactors.collect()}
    return {user: {item: float(a @ b) for item, b in items.items()} for user, a in users.items()}


def best(scores, k, without=frozenset()):
    left = [(-value, item) for item, value in scores.items() if item not in without]
    return [-value for value, _ in sorted(left)[:k]]


def assert_best(rows, scores, k, rated=None):
    """Compare the scores place by place; near ties may be ordered either way."""
    found = {}
    for user, item, rating in rows:
        assert rating == pytest.approx(scores[user][item], abs=1e-4)
        assert rated is None or item not in rated[user]
        found.setdefault(user, []).append(rating)
    for user, values in found.items():
        expected = best(scores[user], k, rated[user] if rated else frozenset())
        assert sorted(values, reverse=True) == pytest.approx(expected, abs=1e-4)
    return set(found)


@pytest.fixture(params=["one block", "many blocks"])
def way(request, monkeypatch):
    if request.param == "many blocks":
        monkeypatch.setattr(recommender, "BLOCK_VALUES", 250)
    return request.param


def rated_by_user(ratings):
    rated = {}
    for row in ratings.collect():
        rated.setdefault(row["userId"], set()).add(row["movieId"])
    return rated


def test_overrides_apply(model):
    assert model.rank == 4


def test_same_seed_same_model(ratings, model):
    als = recommender.make_als(max_iter=4, blocks=3, regParam=0.1, rank=4)
    again = recommender.fit(als, ratings.repartition(5))
    pairs = ratings.limit(200)
    first = {tuple(row)[:2]: row["prediction"] for row in recommender.predict(model, pairs).collect()}
    second = {tuple(row)[:2]: row["prediction"] for row in recommender.predict(again, pairs).collect()}
    assert first.keys() == second.keys()
    assert all(first[key] == pytest.approx(second[key], abs=1e-4) for key in first)


def test_checkpoints_bound_the_disk_and_change_no_result(ratings):
    """The shuffle files of a few rounds stay, not those of half a fit; factors are the same to the last bit."""
    often = recommender.make_als(max_iter=6, blocks=2, rank=2)
    seldom = recommender.make_als(max_iter=6, blocks=2, rank=2, checkpointInterval=10)
    assert often.getCheckpointInterval() == recommender.CHECKPOINT_ROUNDS <= 3 and seldom.getCheckpointInterval() == 10
    stored = ratings.orderBy("userId", "movieId").coalesce(1).cache()
    first, second = recommender.fit(often, stored), recommender.fit(seldom, stored)
    assert rows_of(first.userFactors) == rows_of(second.userFactors)
    assert rows_of(first.itemFactors) == rows_of(second.itemFactors)


def test_fits_keep_nothing_in_the_heap_and_change_no_result(spark, ratings):
    """Blocks of ratings take their room outside of what Spark manages, so nothing kept may stand in the way."""
    als = recommender.make_als(max_iter=3, blocks=2, rank=2)
    plain = recommender.make_als(max_iter=3, blocks=2, rank=2, intermediateStorageLevel="MEMORY_AND_DISK", finalStorageLevel="MEMORY_AND_DISK")
    stored = ratings.orderBy("userId", "movieId").coalesce(1).cache()
    stored.count()
    before = {info.id() for info in spark.sparkContext._jsc.sc().getRDDStorageInfo()}
    first = recommender.fit(als, stored)
    kept = [info for info in spark.sparkContext._jsc.sc().getRDDStorageInfo() if info.id() not in before]
    assert kept and all(info.memSize() == 0 for info in kept) and any(info.diskSize() for info in kept)
    second = recommender.fit(plain, stored)
    assert rows_of(first.userFactors) == rows_of(second.userFactors)
    assert rows_of(first.itemFactors) == rows_of(second.itemFactors)


def test_unseen_rows_are_dropped(spark, model):
    pairs = spark.createDataFrame([(1, 1), (999_999, 1), (1, 999_999)], "userId int, movieId int")
    assert recommender.predict(model, pairs).count() <= 1


def test_ids_beyond_int_are_refused(spark):
    frame = spark.createDataFrame([(3_000_000_000, 1, 1.0)], "userId bigint, movieId int, rating float")
    with pytest.raises(Exception, match="(?i)overflow|integer range"):
        recommender.fit(recommender.make_als(max_iter=1, rank=2), frame)


@pytest.mark.parametrize("k", [1, 25, 10_000])
def test_recommend_all(model, scores, way, k):
    found = recommender.recommend_all(model, k)
    assert found.dtypes == [("userId", "int"), ("movieId", "int"), ("rating", "float")]
    assert assert_best(found.collect(), scores, k) == set(scores)


def test_users_are_scored_once_when_published(spark, model, monkeypatch, tmp_path):
    """Nothing is shuffled above the scoring, which runs once for each user."""
    assert "Exchange" not in plan_of(recommender.recommend_all(model)).split("MapInArrow")[0]
    scored, products = spark.sparkContext.accumulator(0), recommender._products

    def counted(users, items):
        scored.add(len(users))
        return products(users, items)

    monkeypatch.setattr(recommender, "_products", counted)
    recommender.publish(recommender.recommend_all(model), str(tmp_path / "published"))
    assert scored.value == model.userFactors.count()


def test_blocks_of_users_do_not_matter(model, scores, monkeypatch):
    monkeypatch.setattr(recommender, "_SCORES_AT_ONCE", 1)
    assert assert_best(recommender.recommend_all(model, 5).collect(), scores, 5) == set(scores)


def searched(found):
    users, items, scores = (np.concatenate(column) for column in zip(*found))
    order = np.lexsort((items, users))
    return users[order], items[order], scores[order]


@pytest.mark.parametrize("kind", ["normal", "positive", "equal scores", "ties", "zero"])
def test_few_items_are_scored_in_full(kind, monkeypatch):
    """The same rows as from all products, of which most pairs need none."""
    rng = np.random.default_rng(5)
    own, factors = (rng.normal(size=(size, 6)) for size in (300, 9000))
    if kind == "positive":
        own, factors = np.abs(own), np.abs(factors)
    if kind == "equal scores":
        own, factors = np.ones_like(own), np.ones_like(factors)
    if kind == "ties":
        own, factors = np.round(own), np.round(factors)
    if kind == "zero":
        own[:] = 0
    own, factors = own.astype(np.float32), factors.astype(np.float32)
    counts, ids = rng.integers(0, 60, 300), np.arange(9000) * 2
    counts[:3] = 3000, 8999, 9005
    rows, places, values = recommender._best(recommender._products(own, factors), counts)
    products, pairs = recommender._products, []

    def counted(users, items):
        pairs.append(len(users) * len(items))
        return products(users, items)

    monkeypatch.setattr(recommender, "_products", counted)
    found = searched(recommender._best_items(np.arange(300), counts.astype(float), own, ids, factors))
    expected = searched([(rows, ids[places], values)])
    assert all(np.array_equal(ours, theirs) for ours, theirs in zip(found, expected))
    assert sum(pairs) < 0.1 * len(own) * len(factors)


def test_equal_scores_go_by_item():
    scores = np.array([[1.0, 3.0, 2.0, 3.0, 2.0, 2.0]] * 2, dtype=np.float32)
    for first, second in ((3, 0), (9, 1), (2, 2)):
        rows, places, values = recommender._best(scores, np.array([first, second]))
        expected = [1, 3, 2, 4, 5, 0][:first] + [1, 3, 2][:second]
        assert places.tolist() == expected
        assert rows.tolist() == [0] * min(first, 6) + [1] * second
        assert values.tolist() == [scores[0][place] for place in expected]


@pytest.mark.parametrize("equal", [False, True])
def test_blocks_of_items_do_not_matter(spark, model, ratings, equal, monkeypatch):
    """Any number of items in a block gives the same rows, also where all scores are equal."""
    if equal:
        monkeypatch.setattr(recommender, "_products", lambda users, items: np.ones((len(users), len(items)), np.float32))
    few = ratings.where("userId < 20 AND movieId < 60")
    small = recommender.fit(recommender.make_als(max_iter=1, rank=3, blocks=2), few)
    found = [
        (rows_of(recommender.recommend_all(small, 4, block_items=size)), rows_of(recommender.recommend_unrated(small, few, 4, block_items=size)))
        for size in (1, 7, 10_000)
    ]
    assert found[0] == found[1] == found[2] and all(found[0])
    if equal:
        lowest = {}
        for user, item, _ in found[0][0]:
            lowest.setdefault(user, []).append(item)
        items = sorted(row["id"] for row in small.itemFactors.collect())[:4]
        assert all(sorted(own) == items for own in lowest.values())


def test_recommend_unrated(model, ratings, scores, way):
    rated = rated_by_user(ratings)
    found = recommender.recommend_unrated(model, ratings, 25)
    assert assert_best(found.collect(), scores, 25, rated) == set(scores)


def test_heavy_user_still_gets_everything(spark, model, ratings, scores, way):
    """A user who rated all items but three gets those three; the others are not affected."""
    items = sorted({item for of_user in scores.values() for item in of_user})
    extra = spark.createDataFrame([(1, item, 3.0) for item in items[3:]], ratings.schema)
    more = ratings.where("userId <> 1").union(extra)
    rated = rated_by_user(more)
    found = recommender.recommend_unrated(model, more, 25)
    by_user = found.groupBy("userId").count().collect()
    assert {row["userId"]: row["count"] for row in by_user} == {
        user: min(25, len(items) - len(rated[user])) for user in scores
    }
    assert_best(found.collect(), scores, 25, rated)


def test_recommend_unrated_has_no_product(model, ratings, setting):
    setting("spark.sql.autoBroadcastJoinThreshold", "-1")
    plan = plan_of(recommender.recommend_unrated(model, ratings))
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    # Groups are cut before they are shuffled by user.
    assert plan.count("WindowGroupLimit") == 2
    assert "REPARTITION_BY_NUM" in plan


def test_scoring_uses_all_cores(spark, model, ratings, setting):
    setting("spark.sql.autoBroadcastJoinThreshold", "-1")
    found = recommender.recommend_unrated(model, ratings)
    found.collect()
    final = plan_of(found).split("Initial Plan")[0]
    # The stage below the scoring is read as it was written.
    below = final.split("MapInArrow")[1].split("Exchange")[0]
    assert "AQEShuffleRead" not in below


def test_recommend_unrated_for_some(spark, model, ratings, scores, way):
    users = spark.createDataFrame([(3,), (5,), (5,), (999_999,)], "userId int")
    found = recommender.recommend_unrated(model, ratings, 5, users)
    assert assert_best(found.collect(), scores, 5, rated_by_user(ratings)) == {3, 5} & set(scores)


def test_recommend_unrated_for_nobody(spark, model, ratings, way):
    nobody = spark.createDataFrame([], "userId int")
    found = recommender.recommend_unrated(model, ratings, 5, nobody)
    assert found.collect() == [] and found.columns == ["userId", "movieId", "rating"]


def test_direct_scores(model, ratings, movies, scores):
    user = recommender.most_active_user(ratings)
    own = ratings.where(F.col("userId") == user)
    found = recommender.score_unrated(model, user, own, movies)
    assert found.columns == ["movieId", "title", "genres", "userId", "rating"]
    rows = found.collect()
    assert [row["rating"] for row in rows] == sorted((row["rating"] for row in rows), reverse=True)
    rated = rated_by_user(ratings)[user]
    assert {row["movieId"] for row in rows} == set(scores[user]) - rated
    assert all(row["rating"] == pytest.approx(scores[user][row["movieId"]], abs=1e-4) for row in rows)


def test_direct_scores_need_no_nested_loop(model, ratings, movies, setting):
    setting("spark.sql.autoBroadcastJoinThreshold", "-1")
    own = ratings.where("userId = 3")
    plan = plan_of(recommender.score_unrated(model, 3, own, movies))
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_direct_scores_of_an_unseen_user(model, ratings, movies):
    found = recommender.score_unrated(model, 999_999, ratings.where("userId = 999999"), movies)
    assert found.collect() == [] and found.columns == ["movieId", "title", "genres", "userId", "rating"]


def test_movies_without_id_or_ratings_get_no_score(spark, model, ratings, movies):
    more = movies.union(spark.createDataFrame([(None, "t", "g"), (999_999, "t", "g")], movies.schema))
    own = ratings.where("userId = 3")
    assert rows_of(recommender.score_unrated(model, 3, own, more)) == rows_of(
        recommender.score_unrated(model, 3, own, movies)
    )


def test_both_ways_agree_for_every_user(model, ratings, movies):
    shared = recommender.recommend_all(model).cache()
    rated = rated_by_user(ratings)
    for user in sorted(rated)[::15]:
        own = ratings.where(F.col("userId") == user)
        listed = recommender.unrated_recommendations(shared, user, own, movies).collect()
        scored = recommender.score_unrated(model, user, own, movies).take(len(listed))
        assert not {row["movieId"] for row in listed} & rated[user]
        assert [row["rating"] for row in listed] == pytest.approx([row["rating"] for row in scored], abs=1e-4)
    shared.unpersist()


def test_top_for_user(model, ratings, movies, scores):
    own = ratings.where("userId = 3")
    found = [row["rating"] for row in recommender.top_for_user(model, 3, own, movies, 7).collect()]
    assert found == pytest.approx(best(scores[3], 7, rated_by_user(own)[3]), abs=1e-4)


def test_published_recommendations(spark, model, tmp_path):
    path = str(tmp_path / "recommendations")
    found = recommender.recommend_all(model, 3)
    recommender.publish(found, path)
    table = spark.read.parquet(path)
    assert rows_of(table) == rows_of(found)
    assert "EqualTo(userId,3)" in plan_of(table.where("userId = 3"))
    with pytest.raises(Exception, match="(?i)already exists"):
        recommender.publish(found, path)


def test_saved_model(model, ratings, tmp_path):
    path = str(tmp_path / "model")
    model.write().overwrite().save(path)
    pairs = ratings.limit(500)
    assert rows_of(recommender.predict(ALSModel.load(path), pairs)) == rows_of(recommender.predict(model, pairs))


def test_folds_are_balanced_and_stable(ratings):
    folded = recommender.with_fold(ratings, 5)
    sizes = [row["count"] for row in folded.groupBy("fold").count().collect()]
    assert len(sizes) == 5 and max(sizes) < 1.2 * min(sizes)
    assert rows_of(folded) == rows_of(recommender.with_fold(ratings.repartition(3), 5))
