"""Views over the star-schema test tables that play the part of flights, ratings and movies."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


# The columns in use and their types. Declaring them saves the job that reads a footer
# for the schema, once per table and query.
_COLUMNS = {
    "nation": "n_nationkey int, n_name string",
    "supplier": "s_suppkey bigint, s_nationkey int",
    "customer": "c_custkey bigint, c_nationkey int, c_mktsegment string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderdate timestamp_ntz",
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
        "l_returnflag string, l_shipdate timestamp_ntz"
    ),
}

# Rows that a task should hold at once where it sorts or groups them.
ROWS_PER_TASK = 1 << 18


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(_COLUMNS[name]).parquet(f"{folder.rstrip('/')}/{name}.parquet")


def flights(spark: SparkSession, folder: str, since_year: int | None = None) -> DataFrame:
    """Shipments as flights from the supplier's to the customer's nation.

    ``since_year`` repeats a filter on ``year`` as a range of the stored time stamp, because only
    that can be pushed into the scan. Each large side meets its own dimension before the two large
    sides meet, so the line items are shuffled twice rather than three times.
    """
    items = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_suppkey", "l_shipdate", "l_returnflag"
    )
    if since_year is not None:
        items = items.where(F.col("l_shipdate") >= F.expr(f"timestamp_ntz'{since_year:04d}-01-01 00:00:00'"))
    nations = table(spark, folder, "nation").select("n_nationkey", "n_name")
    origins = (
        table(spark, folder, "supplier")
        .join(nations, F.col("s_nationkey") == F.col("n_nationkey"))
        .select("s_suppkey", F.col("n_name").alias("origin"))
    )
    destinations = (
        table(spark, folder, "customer")
        .join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
        .select("c_custkey", F.col("n_name").alias("dest"))
    )
    departures = items.join(origins, F.col("l_suppkey") == F.col("s_suppkey"))
    arrivals = (
        table(spark, folder, "orders")
        .join(destinations, F.col("o_custkey") == F.col("c_custkey"))
        .select("o_orderkey", "o_orderdate", "dest")
    )
    return departures.join(arrivals, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.year("l_shipdate").cast("int").alias("year"),
        F.quarter("l_shipdate").cast("int").alias("quarter"),
        "origin",
        "dest",
        F.datediff("l_shipdate", "o_orderdate").cast("int").alias("depdelay"),
        F.when(F.col("l_returnflag") == "R", 1).otherwise(0).alias("cancelled"),
    )


def portions(spark: SparkSession, folder: str) -> int:
    """Partitions for frames with a row per line item, so that no task grows with the table; files know their number of rows.

    The number of shuffle partitions is fixed, and adaptive execution merges them by compressed size. A sort of rows
    of a few bytes, or a table of their keys, takes ten times that in memory.
    """
    return max(spark.sparkContext.defaultParallelism, -(-table(spark, folder, "lineitem").count() // ROWS_PER_TASK))


def purchases(spark: SparkSession, folder: str, parts: int | None = None) -> DataFrame:
    """One row per line item with its buyer; a buyer may have bought a part several times."""
    items = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_quantity"
    )
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    parts = parts or portions(spark, folder)
    return items.repartition(parts, "l_orderkey").join(
        orders.repartition(parts, "o_orderkey"), F.col("l_orderkey") == F.col("o_orderkey")
    )


def ratings(spark: SparkSession, folder: str) -> DataFrame:
    """One half-star rating per buyer and part; random, so nothing can be learnt from it."""
    stars, parts = F.ceil(F.col("l_quantity") / 5.0) / 2.0, portions(spark, folder)
    return (
        purchases(spark, folder, parts)
        .select(
            F.col("o_custkey").cast("int").alias("userId"),
            F.col("l_partkey").cast("int").alias("movieId"),
            stars.alias("stars"),
        )
        .repartition(parts, "userId", "movieId")
        .groupBy("userId", "movieId")
        .agg(F.max("stars").cast("float").alias("rating"))
    )


def planted_ratings(spark: SparkSession, folder: str) -> DataFrame:
    """The same pairs with a rating of low rank, which a factorization has to find."""
    angle = 2 * F.pi() * (F.col("userId") % 7 - F.col("movieId") % 7) / 7.0
    rating = (F.round(2 * (2.75 + 2.0 * F.cos(angle))) / 2.0).cast("float")
    parts = portions(spark, folder)
    pairs = purchases(spark, folder, parts).select(
        F.col("o_custkey").cast("int").alias("userId"),
        F.col("l_partkey").cast("int").alias("movieId"),
    )
    return pairs.repartition(parts, "userId", "movieId").distinct().withColumn("rating", rating)


def movies(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "part").select(
        F.col("p_partkey").cast("int").alias("id"),
        F.col("p_name").alias("title"),
        F.concat("p_type", F.lit("|"), "p_brand").alias("genres"),
    )
