"""One query per operator. Each takes (spark, folder of the tables) and returns a frame.

Where a result depends on a trained model or on random numbers, the query returns figures that
hold whatever the model: counts, ids, and the number of violations of a property.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml.recommendation import ALSModel
from pyspark.ml.tuning import CrossValidatorModel
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallymill.functions import ids, metrics
from tallymill.functions.text import stringify_array
from tallymill.operators import caching, ranking, sampling, sets
from tallymill.plans import audit, recommender, reports, runs, sampler, stand_ins, tuning
from tallymill.session import working_path
from tallymill.sources import readers, writers

KEYS = ["userId", "movieId"]
TOLERANCE = 1e-4

_models: dict[tuple[str, str, str], str] = {}


def _base(spark: SparkSession, sf: str) -> DataFrame:
    return reports.report_base(stand_ins.flights(spark, sf, since_year=reports.SINCE_YEAR))


def _report(name: str):
    spec = next(report for report in reports.REPORTS if report.name == name)
    return lambda spark, sf: reports.build_report(_base(spark, sf), spec)


def _labelled(frame: DataFrame) -> DataFrame:
    return sampling.with_split(frame, tuning.HOLDOUT_SPLIT, KEYS)


def _model(spark: SparkSession, sf: str, rows: str) -> ALSModel:
    """Default model of all planted ratings, or of their train rows; fitted and stored once per session."""
    key = (spark.sparkContext.applicationId, sf, rows)
    if key not in _models:
        ratings = stand_ins.planted_ratings(spark, sf)
        if rows == "train":
            ratings = _labelled(ratings).where(F.col("split") == "train").drop("split")
        path = working_path(spark, "shared-model")
        recommender.fit(recommender.make_als(), ratings).write().save(path)
        _models[key] = path
    return ALSModel.load(_models[key])


def _written(spark: SparkSession, frame: DataFrame, name: str) -> DataFrame:
    """The frame as a table in the shared folder, for queries that use it several times."""
    path = working_path(spark, name)
    writers.write_table(frame, path)
    return spark.read.schema(frame.schema).parquet(path)


def _user_ratings(spark: SparkSession, sf: str) -> tuple[int, DataFrame]:
    ratings = stand_ins.planted_ratings(spark, sf)
    user = recommender.most_active_user(ratings)
    return user, ratings.where(F.col("userId") == user)


# Scans and sinks ------------------------------------------------------------------------------


def scan_parquet_flights(spark, sf):
    path = working_path(spark, "flights")
    writers.write_table(stand_ins.flights(spark, sf), path)
    return readers.read_flights(spark, path).agg(
        F.count("*").alias("flights"),
        F.min("year").alias("first_year"),
        F.max("year").alias("last_year"),
        F.count_if(F.col("cancelled") == 1).alias("cancelled"),
    )


def flights_after_coalesce(spark, sf):
    path = working_path(spark, "flights")
    writers.write_table(stand_ins.flights(spark, sf), path)
    scan = readers.read_flights(spark, path)
    kept = caching.coalesce_after_filter(reports.report_base(scan), scan)
    return ranking.group_counts(kept, ["quarter"], "flights")


def _csv_ratings(spark, sf, name, **options):
    path = working_path(spark, name)
    timed = stand_ins.ratings(spark, sf).withColumn("ts", F.lit(0).cast("long"))
    writers.write_table(timed, path, "csv", header=True, **options)
    return path


def scan_csv_ratings(spark, sf):
    return readers.read_ratings(spark, _csv_ratings(spark, sf, "ratings"), mode="FAILFAST")


def scan_csv_gzip_ratings(spark, sf):
    path = _csv_ratings(spark, sf, "ratings-gzip", compression="gzip")
    return readers.read_ratings(spark, path)


def scan_csv_movies_quoted(spark, sf):
    path = working_path(spark, "movies")
    title = F.concat(F.lit('"'), "title", F.lit('", or the '), "title", F.lit(' "cut", à la carte'))
    writers.write_table(stand_ins.movies(spark, sf).withColumn("title", title), path, "csv", header=True)
    return readers.read_movies(spark, path)


def _report_files(single_pass):
    def query(spark, sf):
        base = _base(spark, sf)
        paths = reports.write_all_reports(base, working_path(spark, "reports"), single_pass)
        return reports.read_reports(spark, paths, dict(base.dtypes))

    return query


def run_metrics(spark, sf):
    rated = _labelled(stand_ins.ratings(spark, sf))
    rows = rated.groupBy("split").agg(F.count("*").cast("double").alias("value")).select(
        F.lit("data").alias("run"), F.lit("rows").alias("metric"), "split", "value"
    )
    baseline = metrics.split_baseline_rmse(rated).select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit("baseline").alias("run"),
                        F.lit(metric).alias("metric"),
                        F.lit(split).alias("split"),
                        F.round(column, 6).alias("value"),
                    )
                    for metric, split, column in (
                        ("mean_rating", "train", "train_mean"),
                        ("rmse", "test", "baseline_rmse"),
                    )
                ]
            )
        )
    )
    return rows.unionByName(baseline)


# Projections and expressions ------------------------------------------------------------------


def user_ratings(spark, sf):
    return _user_ratings(spark, sf)[1]


def explode_user_movies(spark, sf):
    """All ratings, nested per user and hundred of movies, so that no array grows with a user, and flattened again."""
    entry = F.struct("movieId", "rating")
    nested = (
        stand_ins.ratings(spark, sf)
        .groupBy("userId", F.floor(F.col("movieId") / 100).alias("hundred"))
        .agg(F.collect_list(entry).alias("recommendations"))
    )
    return ranking.flatten_nested(nested, "userId", "movieId", "rating")


def stringify(spark, sf):
    size = F.when(F.col("p_size") >= 10, F.col("p_size").cast("string"))
    return stand_ins.table(spark, sf, "part").select(
        F.col("p_partkey").cast("int").alias("id"),
        stringify_array(F.array("p_type", "p_brand", size)).alias("properties"),
    )


def _id_figures(frame, name, parts):
    """Ids are dealt by value, because tasks before the shuffle would keep a table of all theirs."""
    return frame.select(name).repartition(parts, name).agg(
        F.count("*").alias("rows"), F.countDistinct(name).alias("ids"), F.count_if(F.col(name) < 0).alias("negative")
    )


def unique_id(spark, sf):
    parts = max(7, stand_ins.portions(spark, sf))
    items = stand_ins.table(spark, sf, "lineitem").select("l_orderkey").repartition(parts)
    return _id_figures(ids.with_unique_id(items), "unique_id", parts)


def unique_id_prepended(spark, sf):
    parts = max(7, stand_ins.portions(spark, sf))
    items = stand_ins.table(spark, sf, "lineitem").select("l_orderkey").repartition(parts)
    numbered = ids.prepend_unique_id(items, stride=parts)
    if numbered.columns[0] != "id":
        raise AssertionError("the id is not the first column")
    return _id_figures(numbered, "id", parts)


# Joins and sets -------------------------------------------------------------------------------


def rated_movies_user(spark, sf):
    user, rated = _user_ratings(spark, sf)
    joined = sets.inner_lookup(rated, stand_ins.movies(spark, sf), "movieId", "id")
    return joined.select("id", "title", "genres")


def unrated_movies_user(spark, sf):
    user, rated = _user_ratings(spark, sf)
    unrated = sets.exclude_keys(stand_ins.movies(spark, sf), rated, {"id": "movieId"})
    return unrated.withColumnRenamed("id", "movieId").withColumn("userId", F.lit(user))


def movies_except_rated(spark, sf):
    return sets.subtract_rows(stand_ins.movies(spark, sf), rated_movies_user(spark, sf))


def ratings_except_planted(spark, sf):
    return sets.subtract_rows(stand_ins.ratings(spark, sf), stand_ins.planted_ratings(spark, sf))


def decorated_ratings(spark, sf):
    return recommender.decorate(stand_ins.ratings(spark, sf), stand_ins.movies(spark, sf))


def distinct_users(spark, sf):
    return sets.distinct_values(stand_ins.ratings(spark, sf), "userId")


def distinct_routes(spark, sf):
    return sets.distinct_values(_base(spark, sf).select("origin", "dest", "quarter"))


def dedupe_any_key(spark, sf):
    parts = stand_ins.portions(spark, sf)
    kept = sets.dedupe_any(stand_ins.purchases(spark, sf, parts), ["o_custkey", "l_partkey"], parts)
    return kept.agg(F.count("*").alias("rows"), F.countDistinct("o_custkey", "l_partkey").alias("keys"))


def dedupe_by_key(spark, sf):
    kept = sets.dedupe_first(
        stand_ins.purchases(spark, sf),
        ["o_custkey", "l_partkey"],
        [F.desc("l_quantity"), "l_orderkey", "l_linenumber"],
    )
    return kept.select("o_custkey", "l_partkey", "l_orderkey", "l_linenumber", "l_quantity")


# Aggregates and top-k -------------------------------------------------------------------------


def mean_rating(spark, sf):
    return metrics.mean_rating(stand_ins.ratings(spark, sf)).select(
        F.round("mean_rating", 6).alias("mean_rating")
    )


def table_counts(spark, sf):
    frames = {
        "ratings": stand_ins.ratings(spark, sf),
        "movies": stand_ins.movies(spark, sf),
        "flights": stand_ins.flights(spark, sf),
    }
    counts = [
        frame.agg(F.count("*").alias("rows")).select(F.lit(name).alias("name"), "rows")
        for name, frame in frames.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def baseline_rmse(spark, sf):
    figures = metrics.split_baseline_rmse(_labelled(stand_ins.ratings(spark, sf)))
    return figures.select(F.round("baseline_rmse", 6).alias("baseline_rmse"))


def baseline_improvement(spark, sf):
    """How much better the item means of the train rows predict than their overall mean."""
    labelled = _labelled(stand_ins.planted_ratings(spark, sf))
    train = labelled.where(F.col("split") == "train")
    test = labelled.where(F.col("split") == "test").drop("split")
    means = train.groupBy("movieId").agg(F.avg(F.col("rating").cast("double")).alias("item_mean"))
    overall = metrics.mean_rating(train).scalar()
    errors = test.join(means, "movieId").select("rating", "item_mean", overall.alias("mean")).agg(
        metrics.rmse(F.col("rating"), F.col("mean")).alias("base"),
        metrics.rmse(F.col("rating"), F.col("item_mean")).alias("value"),
    )
    return errors.select(
        F.round("base", 6).alias("baseline_rmse"),
        F.round("value", 6).alias("item_mean_rmse"),
        F.round(metrics.improvement_percent(F.col("base"), F.col("value")), 6).alias("improvement"),
    )


def topk_movies_per_user(spark, sf):
    return ranking.top_k_per_group(
        stand_ins.ratings(spark, sf), ["userId"], "rating", ["movieId"], recommender.TOP_K, "position"
    )


def topk_beyond_group_limit(spark, sf):
    """More rows per group than the optimizer cuts in each task."""
    items = stand_ins.table(spark, sf, "lineitem").select("l_returnflag", "l_orderkey", "l_linenumber", "l_quantity")
    return ranking.top_k_per_group(items, ["l_returnflag"], "l_quantity", ["l_orderkey", "l_linenumber"], 1500)


# Sampling and splitting -----------------------------------------------------------------------


def sample_by_fractions(spark, sf):
    ratings = stand_ins.ratings(spark, sf)
    fraction = sampler.RATIO
    values = {half / 2.0: fraction for half in range(1, 11)}
    drawn = sampling.sample_by_fractions(ratings, "rating", values)
    sizes = ratings.groupBy("rating").agg(F.count("*").alias("rows"))
    kept = drawn.groupBy("rating").agg(F.count("*").alias("kept"))
    expected, spread = F.col("rows") * fraction, F.sqrt(F.col("rows") * fraction * (1 - fraction))
    return sizes.join(kept, "rating", "left").select(
        F.col("rating").cast("double").alias("rating"),
        "rows",
        (F.abs(F.coalesce("kept", F.lit(0)) - expected) <= 6 * spread).alias("plausible"),
    )


def stratified_sample_hash(spark, sf):
    return sampling.stratified_sample(
        stand_ins.ratings(spark, sf), "userId", sampler.RATIO, KEYS, "sample-42"
    )


def stratified_sample_exact(spark, sf):
    ratings = _written(spark, stand_ins.ratings(spark, sf), "ratings")
    return sampling.stratified_sample_exact(ratings, "userId", sampler.RATIO, KEYS, "sample-42")


def stratified_sample_sliced(spark, sf):
    """The same with strata cut into slices of the digest range."""
    ratings = _written(spark, stand_ins.ratings(spark, sf), "ratings")
    strata = ratings.withColumn("half", F.col("userId") % 2)
    return sampling.stratified_sample_exact(strata, "half", sampler.RATIO, KEYS, "sample-42", rows_per_slice=2000)


def sampled_ratings_file(spark, sf):
    out = working_path(spark, "sample")
    sampler.sample_ratings(spark, _csv_ratings(spark, sf, "ratings"), out)
    return readers.read_ratings(spark, out)


def split3_hash(spark, sf):
    return _labelled(stand_ins.ratings(spark, sf))


def split2_hash(spark, sf):
    parts = sampling.hash_split(stand_ins.ratings(spark, sf), list(tuning.CV_SPLIT.values()), KEYS)
    named = [part.withColumn("split", F.lit(name)) for name, part in zip(tuning.CV_SPLIT, parts)]
    return reduce(DataFrame.unionByName, named)


def random_split3(spark, sf):
    parts = sampling.random_split(stand_ins.ratings(spark, sf), [0.8, 0.1, 0.1])
    together = reduce(DataFrame.unionByName, parts)
    return together.agg(
        F.count("*").alias("rows"), F.countDistinct("userId", "movieId").alias("pairs")
    )


# Collaborative filtering ----------------------------------------------------------------------


def als_predict_coverage(spark, sf):
    """Test rows that get a prediction: those of users and items with train rows."""
    labelled = _labelled(stand_ins.planted_ratings(spark, sf))
    test = labelled.where(F.col("split") == "test").drop("split")
    predicted = recommender.predict(_model(spark, sf, "train"), test)
    return predicted.where(F.col("prediction").isNotNull()).select("userId", "movieId", "rating")


def als_beats_baseline(spark, sf):
    """A model with the default number of rounds and of factors halves the error of the mean."""
    labelled = _labelled(stand_ins.planted_ratings(spark, sf))
    train = labelled.where(F.col("split") == "train").drop("split")
    test = labelled.where(F.col("split") == "test").drop("split")
    als = recommender.make_als(blocks=8, rank=tuning.RANKS[0], regParam=tuning.REG_PARAMS[1])
    predicted = recommender.predict(recommender.fit(als, train), test)
    error = predicted.agg(metrics.rmse(F.col("rating"), F.col("prediction")).alias("rmse")).scalar()
    return metrics.baseline_rmse(train, test).select(
        F.round("baseline_rmse", 6).alias("baseline_rmse"),
        (error < 0.5 * F.col("baseline_rmse")).alias("halved"),
    )


def saved_model_predictions(spark, sf):
    model = _model(spark, sf, "all")
    path = working_path(spark, "model")
    model.write().save(path)
    ratings = stand_ins.planted_ratings(spark, sf)
    again = recommender.predict(ALSModel.load(path), recommender.predict(model, ratings).withColumnRenamed("prediction", "first"))
    return again.agg(
        F.count("*").alias("rows"),
        F.count_if(F.col("prediction") != F.col("first")).alias("different"),
    )


def recommend_all_flat(spark, sf):
    """Per user: number of items, distinct items, and scores that differ from the model's own."""
    model = _model(spark, sf, "all")
    recommended = recommender.recommend_all(model)
    checked = recommender.predict(model, recommended)
    return checked.groupBy("userId").agg(
        F.count("*").alias("items"),
        F.countDistinct("movieId").alias("distinct_items"),
        F.count_if(F.abs(F.col("rating") - F.col("prediction")) > TOLERANCE).alias("different"),
    )


def recommend_all_by_model(spark, sf):
    """The model's own top-k agrees with ours, place by place, in the scores."""
    model = _model(spark, sf, "all")
    place = F.row_number().over(Window.partitionBy("userId").orderBy(F.desc("rating"), "movieId"))
    own = recommender.recommend_all(model).withColumn("place", place)
    nested = model.recommendForAllUsers(recommender.TOP_K)
    flat = ranking.flatten_nested(nested, "userId", "movieId", "rating").withColumn("place", place)
    other = flat.select("userId", "place", F.col("rating").alias("other"))
    return own.join(other, ["userId", "place"], "full").groupBy("userId").agg(
        F.count("*").alias("items"),
        F.count_if(
            F.coalesce(F.abs(F.col("rating") - F.col("other")) > TOLERANCE, F.lit(True))
        ).alias("different"),
    )


def unrated_prediction_user(spark, sf):
    user, rated = _user_ratings(spark, sf)
    scored = recommender.score_unrated(
        _model(spark, sf, "all"), user, rated, stand_ins.movies(spark, sf)
    )
    checked = recommender.predict(_model(spark, sf, "all"), scored)
    return checked.select(
        "movieId",
        "title",
        "genres",
        "userId",
        (F.abs(F.col("rating") - F.col("prediction")) <= TOLERANCE).alias("as_predicted"),
    )


def _published(spark, frame):
    path = working_path(spark, "published")
    recommender.publish(frame, path)
    return spark.read.schema(frame.schema).parquet(path)


def published_recommendations(spark, sf):
    """The shared table read back: items per user, and users out of order or in several files."""
    shared = _published(spark, recommender.recommend_all(_model(spark, sf, "all")))
    return shared.withColumn("file", F.input_file_name()).groupBy("userId").agg(
        F.count("*").alias("items"), F.countDistinct("file").alias("files")
    )


def recommend_block_sizes(spark, sf):
    """Rows that differ between seven blocks of items and a single one."""
    model = _model(spark, sf, "all")
    seventh = -(-model.itemFactors.count() // 7)
    one = recommender.recommend_all(model).withColumn("one", F.lit(1))
    other = recommender.recommend_all(model, block_items=seventh).withColumn("other", F.lit(1))
    return one.join(other, ["userId", "movieId", "rating"], "full").groupBy("userId").agg(
        F.count("one").alias("items"), F.count_if(F.col("one").isNull() | F.col("other").isNull()).alias("different")
    )


def unrated_recommendation_user(spark, sf):
    user, rated = _user_ratings(spark, sf)
    shared = _published(spark, recommender.recommend_all(_model(spark, sf, "all")))
    movies = stand_ins.movies(spark, sf)
    left = recommender.unrated_recommendations(shared, user, rated, movies)
    own = shared.where(F.col("userId") == user)
    removed = own.join(rated, KEYS, "left_semi").select("movieId")
    still_rated = left.join(rated, KEYS, "left_semi")
    return left.agg(
        F.max("userId").alias("userId"),
        (F.count("title") + removed.agg(F.count("*")).scalar()).alias("recommended"),
    ).withColumn("still_rated", still_rated.agg(F.count("*")).scalar())


def paths_agree(spark, sf):
    """What the shared table leaves to a user without the rated items are the best of all unrated ones, for as many
    places as it has: no unrated item scores higher and is missing, none is rated, and scores are the model's."""
    ratings = _written(spark, stand_ins.planted_ratings(spark, sf), "planted")
    model = _model(spark, sf, "all")
    shared = _published(spark, recommender.recommend_all(model))
    left = _written(spark, sets.exclude_keys(shared, ratings, KEYS), "left")
    audited = audit.audited(model, left, excluded=ratings)
    faults = F.col("repeated") + F.col("excluded") + F.col("wrong") + F.col("left_out")
    found = audited.select("userId", faults.alias("different"))
    users = ratings.select("userId").distinct()
    return users.join(found, "userId", "left").select("userId", F.coalesce("different", F.lit(0)).cast("long").alias("different"))


def top_n_for_user(spark, sf):
    user, rated = _user_ratings(spark, sf)
    model, movies = _model(spark, sf, "all"), stand_ins.movies(spark, sf)
    best = recommender.top_for_user(model, user, rated, movies)
    lowest = best.agg(F.min("rating")).scalar()
    better = recommender.score_unrated(model, user, rated, movies).where(F.col("rating") > lowest)
    return best.agg(
        F.max("userId").alias("userId"),
        F.count("*").alias("movies"),
        (better.agg(F.count("*")).scalar() <= F.count("*")).alias("none_better_left_out"),
    )


def _unrated_figures(spark, recommended, ratings, model, users=None):
    """Per user: items, how many are rated after all, and how many have wrong scores, come twice, or are missing."""
    lists = _written(spark, recommended, "unrated")
    # Who has rated everything has no list, and nothing is missing in it.
    return audit.audited(model, lists, recommender.TOP_K, ratings, users).where("items + left_out > 0").select(
        "userId",
        "items",
        F.col("excluded").alias("still_rated"),
        (F.col("wrong") + F.col("repeated") + F.col("left_out")).alias("different"),
    )


def recommend_unrated_all(spark, sf):
    ratings = _written(spark, stand_ins.planted_ratings(spark, sf), "planted")
    model = _model(spark, sf, "all")
    return _unrated_figures(spark, recommender.recommend_unrated(model, ratings), ratings, model)


def recommend_user_subset(spark, sf):
    """The same for a set of users: the customers of one market segment."""
    ratings = _written(spark, stand_ins.planted_ratings(spark, sf), "planted")
    members = stand_ins.table(spark, sf, "customer").where(F.col("c_mktsegment") == "BUILDING")
    users = members.select(F.col("c_custkey").cast("int").alias("userId"))
    model = _model(spark, sf, "all")
    return _unrated_figures(spark, recommender.recommend_unrated(model, ratings, users=users), ratings, model, users)


def holdout_grid_metrics(spark, sf):
    """The default grid and number of rounds."""
    return _sql_known(tuning.holdout_search(recommender.make_als(), stand_ins.planted_ratings(spark, sf)).metrics)


def cv_grid_metrics(spark, sf):
    """The default grid, folds and number of rounds."""
    als = recommender.make_als(blocks=2)
    found = tuning.cross_validated_search(als, stand_ins.planted_ratings(spark, sf), parallelism=8)
    return _sql_known(found.metrics)


def _pipeline(mode):
    def query(spark, sf):
        """From files to published tables: figures of the run, of the lists, and of the models that were saved."""
        root = working_path(spark, "run")
        inputs = {"ratings": stand_ins.planted_ratings(spark, sf).withColumn("ts", F.lit(0).cast("long")), "movies": stand_ins.movies(spark, sf)}
        for name, frame in inputs.items():
            writers.write_table(frame, f"{root}/{name}", "csv", header=True)
        run = runs.run_recommender(spark, mode, f"{root}/ratings", f"{root}/movies", f"{root}/out", blocks=2, parallelism=8, audited=True)
        ratings = readers.read_ratings(spark, f"{root}/ratings")
        models = {"model": ALSModel.load(f"{root}/out/model")}
        if mode == runs.CROSS_VALIDATED:
            models["cv-model"] = CrossValidatorModel.load(f"{root}/out/cv-model").bestModel
        figures = [
            run.audit.agg(F.sum(F.col("repeated") + F.col("excluded") + F.col("wrong") + F.col("left_out")).cast("long")).scalar().alias("wrong_unrated"),
            run.recommendations.select("userId").distinct().agg(F.count("*")).scalar().alias("users"),
            run.recommendations.agg(F.count("*")).scalar().alias("recommended"),
        ]
        for name, model in models.items():
            scored = recommender.predict(model, ratings)
            error = scored.agg(metrics.rmse(F.col("rating"), F.col("prediction"))).scalar()
            base = metrics.mean_rating(ratings).scalar()
            plain = ratings.select("rating", base.alias("mean")).agg(metrics.rmse(F.col("rating"), F.col("mean"))).scalar()
            figures.append((error < plain).alias(name.replace("-", "_") + "_beats_mean"))
        return spark.range(1).select(*figures)

    return query


def _sql_known(table):
    """Values that follow from the data are kept. Of trained ones it is checked that an error is positive, that
    the winner has the least one of the grid and lies below the baseline, and that the improvement follows from the two
    test errors."""
    best = F.when(F.col("run") == "best", F.col("value"))
    baseline = F.when(F.col("run") == "baseline", F.col("value"))
    tested = table.where((F.col("metric") == "rmse") & (F.col("split") == "test"))
    errors = tested.agg(F.max(best).alias("value"), F.max(baseline).alias("base"))
    improvement = errors.select(metrics.improvement_percent(F.col("base"), F.col("value"))).scalar()
    trained = F.col("metric").isin("rmse", "mean_rmse") & (F.col("run") != "baseline")
    members = table.where(F.col("metric").isin("rmse", "mean_rmse") & ~F.col("run").isin("best", "baseline"))
    least = members.agg(F.min("value")).scalar()
    base = tested.agg(F.max(baseline)).scalar()
    won = F.when(F.col("split") == "validation", F.col("value") == least).otherwise(F.col("value") < base)
    return table.select(
        "run",
        "metric",
        "split",
        F.when(trained & (F.col("run") == "best"), ((F.col("value") > 0) & won).cast("double"))
        .when(trained, (F.col("value") > 0).cast("double"))
        .when(
            F.col("metric") == "improvement_percent",
            (F.abs(F.col("value") - improvement) < 1e-9).cast("double"),
        )
        .otherwise(F.round("value", 6))
        .alias("value"),
    )


QUERIES = {
    "scan_parquet_flights": scan_parquet_flights,
    "flights_after_coalesce": flights_after_coalesce,
    "scan_csv_ratings": scan_csv_ratings,
    "scan_csv_gzip_ratings": scan_csv_gzip_ratings,
    "scan_csv_movies_quoted": scan_csv_movies_quoted,
    "report_files_readback": _report_files(single_pass=True),
    "report_files_separate": _report_files(single_pass=False),
    "run_metrics": run_metrics,
    "flight_base": _base,
    "user_ratings": user_ratings,
    "explode_user_movies": explode_user_movies,
    "stringify_array": stringify,
    "unique_id": unique_id,
    "unique_id_prepended": unique_id_prepended,
    "rated_movies_user": rated_movies_user,
    "unrated_movies_user": unrated_movies_user,
    "movies_except_rated": movies_except_rated,
    "ratings_except_planted": ratings_except_planted,
    "decorated_ratings": decorated_ratings,
    "distinct_users": distinct_users,
    "distinct_routes": distinct_routes,
    "dedupe_any_key": dedupe_any_key,
    "dedupe_by_key": dedupe_by_key,
    **{report.name: _report(report.name) for report in reports.REPORTS},
    "flight_reports_single_pass": lambda spark, sf: reports.single_pass_reports(_base(spark, sf)),
    "mean_rating": mean_rating,
    "table_counts": table_counts,
    "baseline_rmse": baseline_rmse,
    "baseline_improvement": baseline_improvement,
    "topk_movies_per_user": topk_movies_per_user,
    "topk_beyond_group_limit": topk_beyond_group_limit,
    "sample_by_fractions": sample_by_fractions,
    "stratified_sample_hash": stratified_sample_hash,
    "stratified_sample_exact": stratified_sample_exact,
    "stratified_sample_sliced": stratified_sample_sliced,
    "sampled_ratings_file": sampled_ratings_file,
    "split3_hash": split3_hash,
    "split2_hash": split2_hash,
    "random_split3": random_split3,
    "als_predict_coverage": als_predict_coverage,
    "als_beats_baseline": als_beats_baseline,
    "saved_model_predictions": saved_model_predictions,
    "recommend_all_flat": recommend_all_flat,
    "recommend_all_by_model": recommend_all_by_model,
    "recommend_block_sizes": recommend_block_sizes,
    "published_recommendations": published_recommendations,
    "unrated_prediction_user": unrated_prediction_user,
    "unrated_recommendation_user": unrated_recommendation_user,
    "paths_agree": paths_agree,
    "top_n_for_user": top_n_for_user,
    "recommend_unrated_all": recommend_unrated_all,
    "recommend_user_subset": recommend_user_subset,
    "holdout_grid_metrics": holdout_grid_metrics,
    "cv_grid_metrics": cv_grid_metrics,
    "pipeline_holdout": _pipeline(runs.HOLDOUT),
    "pipeline_cv": _pipeline(runs.CROSS_VALIDATED),
}
