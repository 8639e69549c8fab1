"""Search for the best ALS parameters."""

from __future__ import annotations

import math
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from threading import Lock

import numpy as np
from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.param import Param
from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel, ParamGridBuilder
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymill.functions.metrics import baseline_rmse, improvement_percent, rmse
from tallymill.operators.caching import persisted
from tallymill.operators.sampling import with_split
from tallymill.plans.recommender import ITEM, RATING, SEED, USER, fit, predict, with_fold
from tallymill.session import ensure_checkpoint_dir

# The grid, the splits and the number of folds.
RANKS = (10, 12)
REG_PARAMS = (0.5, 0.1, 0.01)
HOLDOUT_SPLIT = {"train": 0.8, "validation": 0.1, "test": 0.1}
CV_SPLIT = {"train": 0.9, "test": 0.1}
FOLDS = 5
PARALLELISM = 5

METRICS_SCHEMA = "run string, metric string, split string, value double"

Params = dict[Param, object]


@dataclass
class SearchResult:
    best: Params
    metrics: DataFrame
    cv_model: CrossValidatorModel | None = None
    refit: ALSModel | None = None


def param_grid(
    als: ALS, ranks: Sequence[int] = RANKS, reg_params: Sequence[float] = REG_PARAMS
) -> list[Params]:
    return ParamGridBuilder().addGrid(als.rank, list(ranks)).addGrid(als.regParam, list(reg_params)).build()


def describe(params: Params) -> str:
    return ", ".join(f"{param.name}={value}" for param, value in sorted(params.items(), key=lambda p: p[0].name))


def lowest_or_none(values: Sequence[float | None]) -> int | None:
    """Index of the smallest value, the first among equals. Missing values and NaN never win."""
    usable = [(value, place) for place, value in enumerate(values) if value is not None and not math.isnan(value)]
    return min(usable)[1] if usable else None


def lowest(values: Sequence[float | None]) -> int:
    """As :func:`lowest_or_none`; it is an error if no value is usable."""
    place = lowest_or_none(values)
    if place is None:
        raise ValueError("no parameter combination gave a usable error")
    return place


def fits_at_once(als: ALS, parallelism: int, fits: int) -> int:
    """How many fits to run side by side: as many as it takes for their blocks to fill the cores.

    A fit is a series of short stages, so half as many again keep the cores busy between them. Large
    data has a block per core and more; its fits run nearly one by one and do not crowd the memory.
    """
    return max(1, min(fits, -(-3 * parallelism // (2 * als.getNumUserBlocks()))))


def evaluator() -> RegressionEvaluator:
    return RegressionEvaluator(metricName="rmse", labelCol=RATING, predictionCol="prediction")


def score(predictions: DataFrame) -> tuple[float | None, int]:
    """Error and row count of a frame of predictions, in one job."""
    row = predictions.agg(
        rmse(F.col(RATING), F.col("prediction")).alias("rmse"), F.count("*").alias("rows")
    ).first()
    return row["rmse"], row["rows"]


def metrics_table(spark: SparkSession, rows: list[tuple[str, str, str, float | None]]) -> DataFrame:
    """Figures of a run as a table ``(run, metric, split, value)``; a few dozen rows at most."""
    plain = [(run, metric, split, None if value is None else float(value)) for run, metric, split, value in rows]
    return spark.createDataFrame(plain, METRICS_SCHEMA)


def holdout_search(
    als: ALS,
    ratings: DataFrame,
    grid: Sequence[Params] | None = None,
    weights: dict[str, float] | None = None,
    seed: int | str = SEED,
    parallelism: int | None = None,
) -> SearchResult:
    """Fit every combination on the train rows and keep the one with the lowest validation error.

    The winner is scored on the test rows and compared with the mean of the train rows. ``weights``
    names the three parts in order. ``parallelism`` is the number of fits that run side by side.
    """
    grid = list(grid) if grid is not None else param_grid(als)
    weights = weights or HOLDOUT_SPLIT
    spark = ratings.sparkSession
    ensure_checkpoint_dir(spark)
    labelled = with_split(ratings.select(USER, ITEM, RATING), weights, [USER, ITEM], seed)
    # On disk, because the heap is needed by the fits.
    with persisted(labelled, level=StorageLevel.DISK_ONLY):
        train, validation, test = (
            labelled.where(F.col("split") == name).drop("split") for name in weights
        )

        kept: dict[int, ALSModel] = {}
        errors: dict[int, float | None] = {}
        deciding = Lock()

        def attempt(member: tuple[int, Params]):
            place, params = member
            model = fit(als, train, params)
            error, count = score(predict(model, validation))
            with deciding:
                # Only the factors of the best model so far stay in the executors.
                kept[place], errors[place] = model, error
                best_so_far = lowest_or_none([errors.get(at) for at in range(len(grid))])
                for at in [at for at in kept if at != best_so_far]:
                    dropped = kept.pop(at)
                    dropped.userFactors.unpersist()
                    dropped.itemFactors.unpersist()
            return error, count

        at_once = parallelism or fits_at_once(als, spark.sparkContext.defaultParallelism, len(grid))
        with ThreadPoolExecutor(max_workers=at_once) as pool:
            # Job groups and tags are inherited by the worker threads.
            attempts = list(pool.map(inheritable_thread_target(spark)(attempt), enumerate(grid)))
        best = lowest([error for error, _ in attempts])
        test_error, test_rows = score(predict(kept[best], test))
        baseline = baseline_rmse(train, test)
        gain = improvement_percent(F.col("baseline_rmse"), F.lit(test_error))
        figures = baseline.select("baseline_rmse", gain.alias("improvement")).first()

    names = list(weights)
    rows = []
    for params, (error, count) in zip(grid, attempts):
        rows.append((describe(params), "rmse", names[1], error))
        rows.append((describe(params), "scored_rows", names[1], count))
    rows += [
        ("best", "rmse", names[1], attempts[best][0]),
        ("best", "rmse", names[2], test_error),
        ("best", "scored_rows", names[2], test_rows),
        ("baseline", "rmse", names[2], figures["baseline_rmse"]),
        ("best", "improvement_percent", names[2], figures["improvement"]),
    ]
    return SearchResult(grid[best], metrics_table(spark, rows))


def with_winner(
    model: CrossValidatorModel, als: ALS, train: DataFrame, params: Params, best: int
) -> CrossValidatorModel:
    """The cross-validated model with the winner that :func:`lowest` finds.

    For models of Spark's own validator, which takes the place of the first NaN for the smallest error; then its model is
    replaced by a fit of the winner, so that the saved model and the reported errors belong to it.
    """
    if int(np.argmin(model.avgMetrics)) == best:
        return model
    rebuilt = CrossValidatorModel(fit(als, train, params), model.avgMetrics, model.subModels, model.stdMetrics)
    return model._copyValues(rebuilt)


Leader = tuple[int, ALSModel] | None


def fold_errors(
    als: ALS, train: DataFrame, grid: Sequence[Params], folds: int, parallelism: int, refits: Sequence[DataFrame] = ()
) -> tuple[np.ndarray, list[Leader]]:
    """Errors by fold and member of the grid; and for each frame of ``refits`` a member and its model of these rows.

    As Spark's validator computes them from the column ``fold``. That one waits for the slowest fit of a fold before it
    begins the next one, and fits the winner last, alone, in as many tasks as a fit has blocks. Here the fits of all folds
    share the workers, no model is kept once it is scored, and workers without a fold left already fit the member that leads
    in the folds that are done. It need not be the winner.
    """
    sizes = {row["fold"]: row["count"] for row in train.groupBy("fold").count().collect()}
    for fold in range(folds):
        if not sizes.get(fold) or sizes[fold] == sum(sizes.values()):
            raise ValueError(f"fold {fold} leaves no rows to score, or none to fit")
    errors = np.full((folds, len(grid)), np.nan)
    done = np.zeros(errors.shape, bool)

    def attempt(fold: int, place: int) -> None:
        model = fit(als, train.where(F.col("fold") != fold).drop("fold"), grid[place])
        error, _ = score(predict(model, train.where(F.col("fold") == fold)))
        errors[fold, place] = math.nan if error is None else error
        done[fold, place] = True

    def lead(rows: DataFrame) -> Leader:
        whole = done.all(axis=1)
        leader = lowest_or_none(errors[whole].mean(axis=0).tolist()) if whole.any() else None
        return None if leader is None else (leader, fit(als, rows, grid[leader]))

    inherited = inheritable_thread_target(train.sparkSession)
    with ThreadPoolExecutor(max_workers=parallelism) as pool:
        attempts = [pool.submit(inherited(attempt), *at) for at in np.ndindex(errors.shape)]
        leaders = [pool.submit(inherited(lead), rows) for rows in refits]
        try:
            for found in attempts:
                found.result()
            return errors, [found.result() for found in leaders]
        except BaseException:
            pool.shutdown(wait=False, cancel_futures=True)
            raise


def winner(als: ALS, rows: DataFrame, grid: Sequence[Params], best: int, leader: Leader) -> ALSModel:
    """The model of the best member: the leader's, if that one won, else another fit."""
    if leader and leader[0] == best:
        return leader[1]
    return fit(als, rows, grid[best])


def cross_validated_search(
    als: ALS,
    ratings: DataFrame,
    grid: Sequence[Params] | None = None,
    weights: dict[str, float] | None = None,
    folds: int = FOLDS,
    parallelism: int = PARALLELISM,
    seed: int = SEED,
    refit: DataFrame | None = None,
) -> SearchResult:
    """Cross-validate every combination on the train rows and score the winner on the test rows.

    Folds are assigned by a hash of the row, so a rerun sees the same ones on any cluster. ``parallelism`` is the number of
    fits that run side by side, of whatever folds. The winner is also fitted on the rows of ``refit``, if given.
    """
    grid = list(grid) if grid is not None else param_grid(als)
    weights = weights or CV_SPLIT
    spark = ratings.sparkSession
    ensure_checkpoint_dir(spark)
    labelled = with_fold(
        with_split(ratings.select(USER, ITEM, RATING), weights, [USER, ITEM], seed), folds
    )
    # On disk, because the heap is needed by the fits.
    with persisted(labelled, level=StorageLevel.DISK_ONLY):
        names = list(weights)
        train, test = (labelled.where(F.col("split") == name).drop("split") for name in names)
        refits = [train, *([] if refit is None else [refit])]
        errors, leaders = fold_errors(als, train, grid, folds, parallelism, refits)
        means = errors.mean(axis=0).tolist()
        best = lowest(means)
        models = [winner(als, rows, grid, best, leader) for rows, leader in zip(refits, leaders)]
        validator = CrossValidator(
            estimator=als,
            estimatorParamMaps=grid,
            evaluator=evaluator(),
            numFolds=folds,
            parallelism=parallelism,
            seed=seed,
            foldCol="fold",
        )
        model = validator._copyValues(CrossValidatorModel(models[0], means, stdMetrics=errors.std(axis=0).tolist()))
        train_error, train_rows = score(model.transform(train))
        test_error, test_rows = score(model.transform(test))
        figures = baseline_rmse(train, test).first()

    rows = [
        (describe(params), "mean_rmse", "folds", value) for params, value in zip(grid, model.avgMetrics)
    ]
    rows += [
        ("best", "rmse", names[0], train_error),
        ("best", "scored_rows", names[0], train_rows),
        ("best", "rmse", names[1], test_error),
        ("best", "scored_rows", names[1], test_rows),
        ("baseline", "rmse", names[1], figures["baseline_rmse"]),
    ]
    return SearchResult(grid[best], metrics_table(spark, rows), model, models[1] if refit is not None else None)
