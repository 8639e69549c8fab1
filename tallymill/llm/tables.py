"""Intermediate tables in the shared folder, and connected components over a table of links."""

from __future__ import annotations

import pickle
import time

from pyspark import Broadcast, cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymill.session import working_path

# Seconds between two collections of the driver's garbage, see :func:`discard`.
COLLECTED_EVERY = 15.0
_collected = {"at": float("-inf")}


def load(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def shipped(spark: SparkSession, value: object) -> Broadcast:
    """Broadcast an object of this package to workers that have no copy of the package; see :func:`received`."""
    return spark.sparkContext.broadcast({"data": cloudpickle.dumps(value)})


def received(shared: Broadcast):
    """What was shipped. A worker unpacks it once and keeps it, and what it learns, for all its tasks."""
    held = shared.value
    if "value" not in held:
        held["value"] = pickle.loads(held.pop("data"))
    return held["value"]


def stored(frame: DataFrame, name: str) -> DataFrame:
    """The frame written once to the shared folder and read back.

    It cuts the lineage and survives the loss of any executor.
    """
    spark = frame.sparkSession
    path = working_path(spark, name)
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def discard(*frames: DataFrame) -> None:
    """Delete the files of frames made by :func:`stored` that no later step reads.

    Spark removes the shuffle files of finished steps once the driver has collected its garbage, which a large driver
    puts off for long, so it is asked to; but not after each of many short steps, because a JVM that spends much of its
    time in collections enlarges its heap.
    """
    if frames and time.monotonic() - _collected["at"] >= COLLECTED_EVERY:
        frames[0].sparkSession.sparkContext._jvm.System.gc()
        _collected["at"] = time.monotonic()
    for frame in frames:
        spark = frame.sparkSession
        for file in frame.inputFiles():
            path = spark._jvm.org.apache.hadoop.fs.Path(file)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, False)


def _nearest(links: DataFrame) -> DataFrame:
    """``(node, low)``: of each node the smallest of itself and its neighbours."""
    both = links.select(F.col("a").alias("node"), F.col("b").alias("other")).unionAll(
        links.select(F.col("b").alias("node"), F.col("a").alias("other"))
    )
    return both.groupBy("node").agg(F.least("node", F.min("other")).alias("low"))


def components(links: DataFrame, name: str) -> DataFrame:
    """``(node, component)`` for every node of the undirected links ``(a long, b long)``.

    ``component`` is the smallest node that can be reached. Alternates two star contractions until
    the links no longer change: first every neighbour larger than a node is hung on the smallest
    neighbour of the node, then the node itself and its smaller neighbours are. Minima are combined
    before the shuffle and hubs are spread by the skew handling of sort-merge joins, so a component
    or a hub of any size never meets in one task. The number of rounds grows with the logarithm of
    the longest chain. No links: no rows. Links with a null end, and loops, are ignored.
    """
    edge = lambda x, y: F.struct(F.greatest(x, y).alias("a"), F.least(x, y).alias("b"))
    current = stored(links.where("a <> b").select(edge("a", "b").alias("e")).select("e.*").distinct(), name)
    size = lambda f: f.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
    before = size(current)
    if not before[0]:
        return current.selectExpr("a AS node", "b AS component")
    while True:
        low = _nearest(current).alias("low")
        # Large star: (a, b) with a > b gives (a, low of b).
        large = (
            current.join(low, F.col("node") == F.col("b"))
            .select("a", F.col("low.low").alias("b"))
            .where("a <> b")
            .distinct()
        )
        large = stored(large, name)
        # Small star: a and its smaller neighbours are hung on the smallest of them.
        small = large.groupBy("a").agg(F.min("b").alias("low"))
        linked = large.join(small, "a").select(F.explode(F.array(edge("b", "low"), edge("a", "low"))).alias("e"))
        following = stored(linked.select("e.*").where("a <> b").distinct(), name)
        discard(current, large)
        after, current = size(following), following
        if after == before:
            break
        before = after
    hung = current.groupBy("a").agg(F.min("b").alias("component")).withColumnRenamed("a", "node")
    roots = current.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return hung.unionAll(roots.join(hung.select("node"), "node", "left_anti"))
