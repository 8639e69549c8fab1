import os

import pytest
from pyspark.ml.recommendation import ALSModel
from pyspark.ml.tuning import CrossValidatorModel
from pyspark.sql import functions as F

from tallymill import cli
from tallymill.plans import recommender, runs, sampler, stand_ins, tuning
from tallymill.sources import readers
from tallymill.sources.writers import write_table
from tests.conftest import SMALL, rows_of


@pytest.fixture
def inputs(spark, tmp_path):
    ratings, movies = str(tmp_path / "ratings"), str(tmp_path / "movies")
    timed = stand_ins.planted_ratings(spark, SMALL).withColumn("ts", F.lit(1).cast("long"))
    write_table(timed, ratings, "csv", header=True, compression="gzip")
    write_table(stand_ins.movies(spark, SMALL), movies, "csv", header=True)
    return ratings, movies


def test_loaded_counts(spark, inputs):
    assert readers.read_ratings(spark, inputs[0]).count() == 5_382
    assert readers.read_movies(spark, inputs[1]).count() == 200


def test_sampler(spark, inputs, tmp_path):
    out = str(tmp_path / "sample")
    sampler.sample_ratings(spark, inputs[0], out, 0.2)
    sample, whole = readers.read_ratings(spark, out), readers.read_ratings(spark, inputs[0])
    assert 0.15 < sample.count() / whole.count() < 0.25
    assert sample.exceptAll(whole).count() == 0
    again = str(tmp_path / "again")
    sampler.sample_ratings(spark, inputs[0], again, 0.2)
    assert rows_of(readers.read_ratings(spark, again)) == rows_of(sample)
    with_time = readers.read_csv(spark, out, readers.schemas.RATINGS)
    assert with_time.where("ts = 1").count() == sample.count()


def test_sampler_keeps_its_input(spark, inputs, tmp_path):
    with pytest.raises(ValueError, match="overlaps"):
        sampler.sample_ratings(spark, inputs[0], str(tmp_path))
    assert readers.read_ratings(spark, inputs[0]).count() == 5_382


@pytest.mark.parametrize("mode", ["ALS", "alscv"])
def test_recommender_from_files(spark, inputs, tmp_path, mode):
    out = str(tmp_path / "out")
    run = runs.run_recommender(
        spark, mode, *inputs, out, user_id=3, k=5, max_iter=5, ranks=(4,), reg_params=(0.1, 0.01), folds=2, audited=mode == "ALS"
    )
    if mode == "ALS":
        faults = [tuple(row) for row in run.audit.orderBy("table").collect()]
        unrated = run.unrated.count()
        assert faults == [("recommendations", 150, 750, 0, 0, 0, 0), ("unrated", 150, unrated, 0, 0, 0, 0)]
    per_user = run.recommendations.groupBy("userId").count().collect()
    assert {row["userId"]: row["count"] for row in per_user} == {user: 5 for user in range(150)}
    rated = {row[0] for row in readers.read_ratings(spark, inputs[0]).where("userId = 3").select("movieId").collect()}
    listed, scored = run.recommended.collect(), run.predicted.collect()
    assert not {row["movieId"] for row in listed} & rated
    assert {row["movieId"] for row in scored}.isdisjoint(rated)
    assert [row["rating"] for row in listed] == pytest.approx(
        [row["rating"] for row in scored[: len(listed)]], abs=1e-4
    )
    assert ALSModel.load(f"{out}/model").rank == 4
    assert os.path.exists(f"{out}/cv-model") == (mode == "alscv")
    if mode == "alscv":
        assert len(CrossValidatorModel.load(f"{out}/cv-model").avgMetrics) == 2
    saved = spark.read.option("header", True).csv(f"{out}/metrics")
    assert saved.count() == run.metrics.count()
    with pytest.raises(Exception, match="(?i)already exists"):
        runs.run_recommender(spark, mode, *inputs, out, max_iter=1, ranks=(2,), reg_params=(0.1,), folds=2)


def test_the_leader_is_fitted_on_all_ratings_beside_the_folds(spark, inputs, tmp_path, monkeypatch):
    """After a cross-validation no fit is left, which would run alone."""
    searched, fits, plain = [], [], tuning.cross_validated_search

    def search(*arguments, **options):
        searched.append(plain(*arguments, **options))
        monkeypatch.setattr(recommender, "fit", lambda *late: fits.append(late))
        return searched[0]

    monkeypatch.setattr(tuning, "cross_validated_search", search)
    out = str(tmp_path / "out")
    run = runs.run_recommender(spark, "ALSCv", *inputs, out, max_iter=1, blocks=2, ranks=(2,), reg_params=(0.1,), folds=2)
    assert run.model is searched[0].refit and not fits


def test_unknown_mode(spark, inputs, tmp_path):
    with pytest.raises(ValueError, match="unknown mode"):
        runs.run_recommender(spark, "SVD", *inputs, str(tmp_path / "out"))


def test_command_line(spark, inputs, tmp_path, capsys):
    flights, out = str(tmp_path / "flights"), str(tmp_path / "reports")
    write_table(stand_ins.flights(spark, SMALL), flights)
    cli.main(["reports", flights, out])
    assert len(os.listdir(os.path.join(out, os.listdir(out)[0]))) == 6
    assert capsys.readouterr().out.count("\n") == 6

    cli.main(["sample", inputs[0], str(tmp_path / "sample"), "--ratio", "0.5"])
    assert readers.read_ratings(spark, str(tmp_path / "sample")).count() > 2_000

    cli.main(
        ["recommend", "ALS", *inputs, str(tmp_path / "rec"), "--user", "3", "--max-iter", "2", "--ranks", "2",
         "--reg-params", "0.1", "--top", "3", "--user-list", str(tmp_path / "list"), "--audit"]
    )
    files = [name for name in os.listdir(tmp_path / "list") if name.startswith("part-")]
    assert len(files) == 1
    lines = (tmp_path / "list" / files[0]).read_text().splitlines()
    ratings = [float(line.rsplit(",", 1)[1]) for line in lines]
    assert len(lines) == 100 and ratings == sorted(ratings, reverse=True)
    assert all(line.split(",")[-2] == "3" for line in lines)
    printed = capsys.readouterr().out
    assert "best parameters: rank=2, regParam=0.1" in printed and "improvement_percent" in printed
    assert printed.count("unrated movies of user 3") == 2 and "left_out" in printed


@pytest.mark.parametrize("arguments", [[], ["reports"], ["sample", "x"], ["recommend", "ALS"], ["other"]])
def test_missing_arguments(arguments):
    with pytest.raises(SystemExit):
        cli.main(arguments)
