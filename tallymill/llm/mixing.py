"""Mix sources to target weights by apportioning equal blocks of words (operator 7)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallymill.functions.hashing import digest_number, key_digest
from tallymill.llm.tables import stored
from tallymill.llm.text import WORD

# Weights of the sources in order, repeating, and the most passes over a source.
WEIGHTS = (5, 2, 1)
MOST_PASSES = 3

# Words of a block, and the number of blocks that a source and its target should at least make; a smaller source has smaller blocks.
BLOCK_WORDS = 128
LEAST_BLOCKS = 128
SHARD_WORDS = 1 << 16
MOST_SHARDS = 4096
SEED = 7


def targets(totals: DataFrame, weights: tuple[int, ...] = WEIGHTS, passes: int = MOST_PASSES) -> DataFrame:
    """Add ``rank``, ``weight`` and ``target`` to a table ``(source, source_size)`` of all sources.

    Sources are weighed in the order of their code points, null last. Their targets add up to the sum
    of all sizes. None exceeds ``passes`` times its source; what it would get beyond is shared
    among the others by weight. Filling all targets evenly, the sources that overflow are the first
    ones in the order of size per weight, so a single pass in this order finds them.
    The table has one row for each source, hence the windows over the whole of it.
    """
    everything = Window.partitionBy(F.lit(0))
    rank = F.row_number().over(everything.orderBy(F.col("source").asc_nulls_last()))
    weight = F.element_at(F.array(*map(F.lit, weights)), F.pmod(F.col("rank") - 1, F.lit(len(weights))) + 1)
    before = everything.orderBy(F.col("limit") / F.col("weight"), "rank").rowsBetween(Window.unboundedPreceding, -1)
    level = (F.col("words") - F.col("used")) / (F.col("weights") - F.col("spent"))
    return (
        totals.withColumn("rank", rank)
        .withColumn("weight", weight.cast("double"))
        .withColumn("limit", F.col("source_size").cast("double") * passes)
        .withColumn("words", F.sum("source_size").over(everything).cast("double"))
        .withColumn("weights", F.sum("weight").over(everything))
        .withColumn("used", F.coalesce(F.sum("limit").over(before), F.lit(0.0)))
        .withColumn("spent", F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
        .withColumn("level", level)
        # The level rises until the first source that does not overflow, which sets it for all that follow, and falls from there.
        .withColumn("shared", F.max(F.when(F.col("weight") * F.col("level") <= F.col("limit"), F.col("level"))).over(everything))
        .withColumn("target", F.least(F.col("weight") * F.col("shared"), "limit"))
        .select("source", "source_size", "rank", "target")
    )


def apportioned(claims: DataFrame, group: list[str], key: str, weight: str, seats: str) -> DataFrame:
    """``group, key, quota``: integer seats per row by Sainte-Laguë's highest quotients.

    The seats of a group go to the highest ``weight / (2 k + 1)``; ties go to the larger weight, then to the
    smaller key. The last quotient to win a seat lies between ``W / (seats + n / 2)`` and
    ``W / (seats - n / 2)`` (times one half) for ``n`` rows of total weight ``W``, so only the few
    seats between these bounds have to be ranked, however many there are to give: about 4 for each row.
    """
    whole = Window.partitionBy(*group)
    half = F.col("n") / 2
    lowest = F.floor(F.col(weight) * (F.col(seats) - half) / F.col("all_weights") - 1.5)
    highest = F.ceil(F.col(weight) * (F.col(seats) + half) / F.col("all_weights") + 1.5)
    bounded = (
        claims.where(F.col(weight) > 0)
        .withColumn("n", F.count("*").over(whole))
        .withColumn("all_weights", F.sum(F.col(weight).cast("double")).over(whole))
        .withColumn("low", F.greatest(F.lit(0), F.least(lowest, F.col(seats))).cast("long"))
        .withColumn("high", F.greatest(F.lit(0), highest).cast("long"))
        .withColumn("left", F.col(seats) - F.sum("low").over(whole))
    )
    quotient = F.col(weight) / (2 * F.col("k") + 1)
    place = F.row_number().over(whole.orderBy(quotient.desc(), F.col(weight).desc(), F.col(key), "k"))
    ranked = bounded.withColumn("k", F.explode(F.sequence("low", "high"))).withColumn("place", place)
    return ranked.groupBy(*group, key).agg(
        (F.min("low") + F.count_if(F.col("place") <= F.col("left"))).cast("long").alias("quota")
    )


def mixed_sources(
    documents: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    block_words: int = BLOCK_WORDS,
    seed: int = SEED,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """How many words of every document the mixture takes.

    ``doc_id, source, size, source_size, target, taken``, one row for each row of ``documents``.

    1. Every source gets a target (:func:`targets`) and a quota of equal blocks by Sainte-Laguë's method. Blocks have
       ``block_words`` words, or as many as it takes for the smallest source or target to make ``LEAST_BLOCKS``, one at
       least. A source is dealt into shards by a seeded hash of the document id, one for each
       ``SHARD_WORDS`` words (``MOST_SHARDS`` at most, a matter of parallelism only), and its quota is
       apportioned among them again, in blocks that are as small as this source needs.
    2. The documents of a shard, in a seeded order, are one stream that is cut into these blocks. A quota of
       several passes takes every block as often; the rest of it takes blocks that are evenly
       spread over the stream from a seeded start. So a source misses its target by a hundredth or by a few words.

    A document is taken to the extent that its blocks are, at most ``MOST_PASSES`` times. Null text
    has no words; documents without words are returned with ``taken`` 0. A null source is a source. Repeated
    rows are documents of their own; rows with one id are told apart by their size, their text and what is kept, so that reruns
    agree. Other columns of ``documents`` than those to ``keep``, which come last, are ignored.
    """
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    digest = F.md5(F.coalesce("text", F.lit("")).cast("binary"))
    sized = stored(documents.select("doc_id", "source", size.alias("size"), digest.alias("digest"), *keep), "sizes")
    aims = stored(targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")), weights), "targets")
    whole = Window.partitionBy("all")
    least = F.least(F.col("source_size").cast("double"), "target")
    fitting = lambda words: F.greatest(F.lit(1), F.least(F.lit(block_words), F.floor(words / LEAST_BLOCKS))).cast("long")
    aims = (
        aims.withColumn("all", F.lit(0))
        .withColumn("unit", fitting(F.coalesce(F.min(F.when(F.col("source_size") > 0, least)).over(whole), F.lit(0))))
        .withColumn("block", fitting(least))
        .withColumn("seats", F.round(F.sum(F.col("source_size").cast("double")).over(whole) / F.col("unit")).cast("long"))
    )
    quotas = apportioned(aims, ["all"], "rank", "target", "seats").select("rank", F.col("quota").alias("units"))
    aims = aims.join(quotas, "rank", "left").withColumn(
        "source_quota", F.round(F.coalesce("units", F.lit(0)) * F.col("unit") / F.col("block")).cast("long")
    )
    shards = F.greatest(F.lit(1), F.least(F.lit(MOST_SHARDS), F.ceil(F.col("source_size") / SHARD_WORDS))).cast("long")
    aims = stored(
        aims.withColumn("shards", shards).select("source", "source_size", "rank", "target", "block", "source_quota", "shards"), "quotas"
    )

    order = digest_number(key_digest(seed, "doc_id"))
    dealt = (
        sized.alias("d")
        .join(aims.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of")))
        .withColumn("order", F.coalesce(order, F.lit(-1)))
        .withColumn("shard", F.pmod("order", "shards"))
    )
    cells = dealt.groupBy("rank", "shard").agg(
        F.sum("size").alias("cell_size"), F.first("source_quota").alias("source_quota"), F.first("block").alias("block")
    )
    cells = stored(cells, "cells")
    cell_quotas = apportioned(cells, ["rank"], "shard", "cell_size", "source_quota")
    blocks = F.greatest(F.lit(1), F.ceil(F.col("cell_size") / F.col("block"))).cast("long")
    cells = (
        cells.drop("source_quota")
        .join(cell_quotas, ["rank", "shard"], "left")
        .withColumn("blocks", blocks)
        .withColumn("quota", F.least(F.coalesce("quota", F.lit(0)), MOST_PASSES * F.col("blocks")))
        .withColumn("passes", F.expr("quota div blocks"))
        .withColumn("extra", F.expr("quota % blocks"))
        .withColumn("start", F.pmod(digest_number(key_digest(seed, "rank", "shard")), "blocks"))
        .select("rank", "shard", "blocks", "passes", "extra", "start")
    )

    stream = Window.partitionBy("rank", "shard").orderBy("order", "doc_id", "size", "digest", *[f"d.{name}" for name in keep])
    stop = F.sum("size").over(stream.rowsBetween(Window.unboundedPreceding, 0))
    chosen = lambda at: F.expr(
        f"(({at} + start) * extra) div blocks - (start * extra) div blocks"
    )
    is_chosen = lambda at: chosen(f"({at} + 1)") - chosen(at)
    ends = is_chosen("first") * ((F.col("first") + 1) * F.col("block") - F.col("begin")) + is_chosen("last") * (
        F.col("stop") - F.col("last") * F.col("block")
    )
    within = F.col("block") * (chosen("last") - chosen("(first + 1)"))
    part = F.when(F.col("size") == 0, 0).when(
        F.col("first") == F.col("last"), is_chosen("first") * F.col("size")
    ).otherwise(ends + within)
    return (
        dealt.withColumn("stop", stop)
        .withColumn("begin", F.col("stop") - F.col("size"))
        .withColumn("first", F.expr("begin div block"))
        .withColumn("last", F.expr("(stop - 1) div block"))
        .join(cells, ["rank", "shard"])
        .select(
            "doc_id",
            "source",
            "size",
            "source_size",
            "target",
            (F.col("passes") * F.col("size") + part).cast("long").alias("taken"),
            *keep,
        )
    )
