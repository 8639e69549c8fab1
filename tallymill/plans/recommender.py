"""Recommendations from alternating least squares."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.param import Param
from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymill.functions.hashing import hash_bucket
from tallymill.operators.ranking import first_per_group, rank_by
from tallymill.operators.sets import exclude_keys, inner_lookup
from tallymill.session import ensure_checkpoint_dir

# Defaults of the recommender.
MAX_ITER = 20
TOP_K = 25
SEED = 42

USER, ITEM, RATING = "userId", "movieId", "rating"

# Blocks of a fit. They take part in its start values, so the number follows neither data nor cluster.
BLOCKS = 10

# Rounds between checkpoints of a fit. Only these rounds' shuffle files lie on disk at a time, and only the last ones'
# after a fit, for as long as its model is in use; ten rounds take ten times the factors for every block.
CHECKPOINT_ROUNDS = 2

# Where a fit keeps ratings and factors between rounds. A task that puts a block together holds its ratings about three times on
# the heap, outside of what Spark manages; blocks kept in memory are not evicted for that, and the executor runs out of it.
FIT_STORAGE = "DISK_ONLY"

# Item factors are dealt in blocks of about so many numbers, users in portions of at most about so many.
BLOCK_VALUES = 4_000_000
PORTION_USERS = 1 << 17
_SCORES_AT_ONCE = 4_000_000

# A search for the best items scores so many of the longest ones in full, and compares the others with what was found in
# tiles of so many users and items, which stay in the cache of a core.
_HEAD, _GROUP, _TILE = 512, 256, 1024


def make_als(max_iter: int = MAX_ITER, seed: int = SEED, blocks: int = BLOCKS, **params) -> ALS:
    """Explicit-feedback ALS that drops rows of unseen users and items when it predicts.

    The seed is always set: the library default differs from process to process. ``blocks`` is the
    number of user and of item blocks and with it the parallelism of a fit. Another number gives
    another model; large data on a large cluster wants one of its own. What a fit keeps lies on disk, which
    changes no result.
    """
    kept = {"intermediateStorageLevel": FIT_STORAGE, "finalStorageLevel": FIT_STORAGE}
    return ALS(
        userCol=USER,
        itemCol=ITEM,
        ratingCol=RATING,
        maxIter=max_iter,
        seed=seed,
        numUserBlocks=blocks,
        numItemBlocks=blocks,
        coldStartStrategy="drop",
        **{"checkpointInterval": CHECKPOINT_ROUNDS, **kept, **params},
    )


def fit(als: ALS, ratings: DataFrame, overrides: dict[Param, object] | None = None) -> ALSModel:
    """Fit, with some parameters replaced; lineage is cut every ``checkpointInterval`` rounds."""
    ensure_checkpoint_dir(ratings.sparkSession)
    return als.fit(ratings, overrides or {})


def predict(model: ALSModel, pairs: DataFrame) -> DataFrame:
    """Predictions for (user, item) rows; rows of unseen users or items are dropped."""
    return model.transform(pairs)


def recommend_all(model: ALSModel, k: int = TOP_K, block_items: int | None = None) -> DataFrame:
    """The ``k`` best items of every user as flat ``(userId, movieId, rating)`` rows, clustered by user.

    The lower item wins among equal scores. Users are dealt by range, so no score is shuffled as long as the items
    are one block, and the tasks hold ranges of users.
    """
    wanted = model.userFactors.select("id", "features", F.lit(k).cast("double").alias("aim"))
    scored, blocks = scored_by_block(model, wanted, _best_items, block_items)
    return scored if blocks == 1 else first_per_group(scored, [USER], [F.desc(RATING), F.asc(ITEM)], k)


def recommend_unrated(
    model: ALSModel,
    ratings: DataFrame,
    k: int = TOP_K,
    users: DataFrame | None = None,
    block_items: int | None = None,
) -> DataFrame:
    """The ``k`` best items each user has not rated, for all users or those in ``users``.

    Cutting to ``k`` before the rated items are removed would leave some users short. So a user
    with ``r`` ratings gets the ``k + r`` best items first, at most ``r`` of which are removed.
    """
    counts = ratings.groupBy(USER).agg(F.count("*").alias("rated"))
    factors = model.userFactors.withColumnRenamed("id", USER)
    if users is not None:
        factors = factors.join(users.select(USER).distinct(), USER, "left_semi")
    wanted = factors.join(counts, USER, "left").select(
        F.col(USER).alias("id"),
        "features",
        (F.coalesce("rated", F.lit(0)) + k).cast("double").alias("aim"),
    )
    scored, _ = scored_by_block(model, wanted, _best_items, block_items)
    unrated = exclude_keys(scored, ratings, [USER, ITEM])
    return first_per_group(unrated, [USER], [F.desc(RATING), F.asc(ITEM)], k)


def score_unrated(model: ALSModel, user_id: int, user_ratings: DataFrame, movies: DataFrame) -> DataFrame:
    """Predicted ratings of all movies one user has not rated, best first.

    The user's factors are a handful of numbers and enter as constants. Handing the model rows that
    all carry the same user would have it join on that one value, which the optimizer turns into a
    nested-loop join that broadcasts the movies.
    """
    columns = [ITEM, "title", "genres", USER, RATING]
    unrated = exclude_keys(movies.where(F.col("id").isNotNull()), user_ratings, {"id": ITEM})
    row = model.userFactors.where(F.col("id") == user_id).first()
    # An unseen user gets no predictions.
    weights = [float(weight) for weight in row["features"]] if row else []
    products = [
        F.col("features")[place] * F.lit(weight).cast("float") for place, weight in enumerate(weights)
    ]
    score = sum(products[1:], products[0]) if products else F.lit(None).cast("float")
    factors = model.itemFactors.select(F.col("id").alias("factor_id"), score.alias(RATING))
    if not row:
        factors = factors.where(F.lit(False))
    scored = inner_lookup(unrated, factors, "id", "factor_id")
    named = scored.withColumnRenamed("id", ITEM).withColumn(USER, F.lit(user_id).cast("int"))
    return rank_by(named.select(*columns), RATING, ITEM)


def unrated_recommendations(
    recommendations: DataFrame, user_id: int, user_ratings: DataFrame, movies: DataFrame
) -> DataFrame:
    """What remains of one user's shared recommendations without the rated movies, best first.

    Rows are excluded by user and movie. A predicted rating practically never equals the given one,
    so a difference of whole rows would exclude nothing.
    """
    own = recommendations.where(F.col(USER) == user_id)
    unrated = exclude_keys(own, user_ratings, [USER, ITEM])
    return rank_by(decorate(unrated, movies), RATING, ITEM)


def decorate(recommendations: DataFrame, movies: DataFrame) -> DataFrame:
    """Add title and genres."""
    joined = inner_lookup(recommendations, movies, ITEM, "id")
    return joined.select(ITEM, "title", "genres", USER, RATING)


def top_for_user(
    model: ALSModel, user_id: int, user_ratings: DataFrame, movies: DataFrame, limit: int = 100
) -> DataFrame:
    return score_unrated(model, user_id, user_ratings, movies).limit(limit)


def most_active_user(ratings: DataFrame) -> int:
    """The user with the most ratings, the smallest id among equals."""
    counts = ratings.groupBy(USER).count().orderBy(F.desc("count"), F.asc(USER))
    return counts.first()[USER]


def with_fold(ratings: DataFrame, folds: int, seed: int | str = "fold") -> DataFrame:
    """Label rows with a cross-validation fold that does not depend on the partitioning."""
    return ratings.withColumn("fold", hash_bucket(seed, USER, ITEM, buckets=folds))


def publish(recommendations: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Write recommendations, sorted by user so that a lookup reads few row groups.

    They come clustered by user and are not dealt anew: a range partitioning would run the whole scoring once
    more, just to sample its result.
    """
    recommendations.sortWithinPartitions(USER, F.desc(RATING), ITEM).write.mode(mode).parquet(path)


# Of some users (ids, aims, factors) and a block of items (ids, factors): users, items and scores.
Scorer = Callable[[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray], Iterator[tuple]]


def _item_blocks(model: ALSModel, blocks: int) -> DataFrame:
    """``(block, ids, features)``: the factors of each block in one row, in ascending order of the items.

    Items are dealt to blocks by a hash of the id, so a row is bounded by the size of a block.
    """
    entries = F.array_sort(F.collect_list(F.struct("id", "features")))
    block = F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int")
    return (
        model.itemFactors.groupBy(block.alias("block"))
        .agg(entries.alias("entries"))
        .select("block", F.col("entries.id").alias("ids"), F.flatten("entries.features").alias("features"))
    )


def scored_by_block(
    model: ALSModel, users: DataFrame, scorer: Scorer, block_items: int | None = None
) -> tuple[DataFrame, int]:
    """Rows ``(userId, movieId, rating)`` that ``scorer`` makes of every user and block of items, and the number of blocks.

    ``users`` are ``(id, features, aim)``. They are cut into portions by ranges of the id; every portion meets every block
    of about ``block_items`` items in a task that gets one row with the block, followed by the users. Both travel by
    shuffles alone, and a task holds one block and one batch of users, whatever the size of the model.
    """
    size = block_items or max(1, BLOCK_VALUES // model.rank)
    blocks = max(1, -(-model.itemFactors.count() // size))
    # A block may be empty, and then has no row.
    tasks = max(model.userFactors.sparkSession.sparkContext.defaultParallelism, model.userFactors.rdd.getNumPartitions())
    portions = max(-(-model.userFactors.count() // PORTION_USERS), -(-tasks // blocks))
    every = lambda count: F.explode(F.sequence(F.lit(0), F.lit(count - 1)))
    cell = (F.col("portion") * blocks + F.col("block")).alias("cell")
    dealt = users.repartitionByRange(portions, "id").withColumn("portion", F.spark_partition_id())
    dealt = dealt.withColumn("block", every(blocks)).select(cell, "id", "aim", "features", F.lit(None).cast("array<int>").alias("ids"))
    items = _item_blocks(model, blocks).withColumn("portion", every(portions))
    items = items.select(cell, F.lit(None).cast("int").alias("id"), F.lit(None).cast("double").alias("aim"), "features", "ids")
    # One task for each cell. The block comes before the users.
    together = dealt.unionByName(items).repartitionById(portions * blocks, "cell")
    sorted_cells = together.sortWithinPartitions("cell", F.asc_nulls_first("id"))
    return sorted_cells.mapInArrow(_meeting(scorer, model.rank), f"{USER} int, {ITEM} int, {RATING} float"), blocks


def _meeting(scorer: Scorer, rank: int):
    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, cell = (), None
        for batch in batches:
            heads = np.flatnonzero(batch["ids"].is_valid().to_numpy(zero_copy_only=False)).tolist()
            for head in heads:
                cell = batch["cell"][head].as_py()
                factors = batch["features"][head].values.to_numpy().reshape(-1, rank)
                held = batch["ids"][head].values.to_numpy(), factors
            people = batch.filter(batch["id"].is_valid())
            if not len(people) or not held:
                continue
            if set(people["cell"].unique().to_pylist()) != {cell}:
                raise AssertionError("users of another cell than that of the block")
            own = people["features"].flatten().to_numpy().reshape(-1, rank)
            for users, items, scores in scorer(people["id"].to_numpy(), people["aim"].to_numpy(), own, *held):
                columns = [pa.array(users, pa.int32()), pa.array(items, pa.int32()), pa.array(scores, pa.float32())]
                yield pa.record_batch(columns, [USER, ITEM, RATING])

    return meet


def _best_items(users: np.ndarray, aims: np.ndarray, own: np.ndarray, ids: np.ndarray, factors: np.ndarray) -> Iterator[tuple]:
    """The ``aims`` best items of every user, the lower item first among equal scores."""
    counts, step = aims.astype(np.int64), max(1, _SCORES_AT_ONCE // len(ids))
    # Rows that want about as many are scored together, and against all items at once if they want a good part of them.
    order = np.argsort(counts, kind="stable")
    few = int(np.searchsorted(4 * np.maximum(counts[order], _HEAD), len(ids)))
    if few:
        lengths = np.linalg.norm(factors.astype(np.float64), axis=1)
        longest = np.argsort(-lengths, kind="stable")
        sorted_items = longest, lengths[longest], factors[longest]
    for start in range(0, few, _GROUP):
        part = order[start : min(few, start + _GROUP)]
        rows, places, values = _search(own[part], counts[part], factors, *sorted_items)
        yield users[part][rows], ids[places], values
    for start in range(few, len(order), step):
        part = order[start : start + step]
        rows, places, values = _best(_products(own[part], factors), counts[part])
        yield users[part][rows], ids[places], values


def _search(
    own: np.ndarray, counts: np.ndarray, factors: np.ndarray, order: np.ndarray, lengths: np.ndarray, by_length: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """As :func:`_best` of the products with all ``factors``; ``order``, ``lengths`` and ``by_length`` are these by falling length.

    The longest items give every user a bound. Of the others only those that may reach it are scored as
    :func:`_products` does, so the result is the same; and bounds rise with what is found.
    """
    first = max(_HEAD, 2 * int(counts.max()))
    head = np.sort(order[:first])
    rows, places, values = _best(_products(own, factors[head]), counts)
    places = head[places]
    reach = np.linalg.norm(own.astype(np.float64), axis=1)
    ends, found, waiting = np.cumsum(counts) - 1, [], 0
    least = np.where(counts > 0, values[ends], np.inf)
    for start in range(first, len(order), _TILE):
        if (reach * (1 + 1e-5) * lengths[start] + 1e-30 < least).all():
            break
        more, at = may_reach(own, reach, least, by_length[start : start + _TILE], lengths[start])
        found.append((more, order[start + at]))
        waiting += len(more)
        if waiting > len(values) or start + _TILE >= len(order):
            rows, places, values = _merged(own, counts, factors, least, (rows, places, values), found)
            found, waiting, least = [], 0, np.where(counts > 0, values[ends], np.inf)
    return _merged(own, counts, factors, least, (rows, places, values), found) if waiting else (rows, places, values)


def _merged(own: np.ndarray, counts: np.ndarray, factors: np.ndarray, least: np.ndarray, best: tuple, found: list) -> tuple:
    rows, places = (np.concatenate(parts) for parts in zip(*found))
    values = np.zeros(len(rows), np.float32)
    for factor in range(own.shape[1]):
        values += own[rows, factor] * factors[places, factor]
    kept = values >= least[rows]
    added = rows[kept], places[kept], values[kept]
    return _cut(*(np.concatenate(pair) for pair in zip(best, added)), counts)


def may_reach(own: np.ndarray, reach: np.ndarray, least: np.ndarray, factors: np.ndarray, longest: float) -> tuple[np.ndarray, np.ndarray]:
    """Rows and places of the pairs whose score may be ``least`` of the row or more: all of these, and few others.

    ``reach`` are the lengths of the users' vectors, ``longest`` is that of the longest item. Scores are those of a
    matrix routine in single precision; the slack is more than what these and those of :func:`_products` can be off.
    """
    slack = reach * longest * ((own.shape[1] + 2) * 2.0**-21) + 1e-30
    live = np.flatnonzero(reach * longest + slack >= least)
    bounds = np.nextafter((least[live] - slack[live]).astype(np.float32), np.float32(-np.inf))
    scores = (own if len(live) == len(own) else own[live]) @ factors.T
    rows, places = np.divmod(np.flatnonzero(scores >= bounds[:, None]), max(1, len(factors)))
    return live[rows], places


def _products(users: np.ndarray, items: np.ndarray) -> np.ndarray:
    """Scores of all pairs. Products are added in the order of the factors, so that a score does not
    depend on how many users and items are multiplied at once, as it does with matrix routines."""
    scores = np.zeros((len(users), len(items)), np.float32)
    product = np.empty_like(scores)
    for factor in range(users.shape[1]):
        np.multiply(users[:, factor, None], items[:, factor], out=product)
        scores += product
    return scores


def _best(scores: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows, places and values of the ``counts`` highest scores of each row, the lower place first among equals."""
    width, most = scores.shape[1], int(counts.max(initial=0))
    if 0 < most < width:
        least = np.partition(scores, width - most, axis=1)[:, width - most]
        rows, places = np.nonzero(scores >= least[:, None])
    else:
        rows, places = (axis.ravel() for axis in np.indices(scores.shape))
    return _cut(rows, places, scores[rows, places], counts)


def _cut(rows: np.ndarray, places: np.ndarray, values: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The ``counts`` highest values of each row, the lower place first among equals."""
    order = np.lexsort((places, -values, rows))
    rows, places, values = rows[order], places[order], values[order]
    position = np.arange(len(rows)) - np.searchsorted(rows, rows)
    kept = position < counts[rows]
    return rows[kept], places[kept], values[kept]
