"""Sampling a ratings file."""

from __future__ import annotations

from pyspark.sql import SparkSession

from tallymill.operators.sampling import stratified_sample
from tallymill.sources.readers import read_csv
from tallymill.sources.schemas import RATINGS
from tallymill.sources.writers import require_separate_output, write_sample

# Share of the rows kept, and the seed.
RATIO = 0.05
SEED = 42


def sample_ratings(
    spark: SparkSession, ratings_path: str, out: str, ratio: float = RATIO, seed: int = SEED
) -> None:
    """Keep ``ratio`` of every user's ratings, with all columns, as gzip CSV.

    Scan, filter and sink form one stage without a shuffle. The salt differs from the one of the
    train/test split, else a sample would consist of train rows only.
    """
    require_separate_output(spark, out, ratings_path)
    ratings = read_csv(spark, ratings_path, RATINGS)
    write_sample(stratified_sample(ratings, "userId", ratio, ["userId", "movieId"], f"sample-{seed}"), out)
