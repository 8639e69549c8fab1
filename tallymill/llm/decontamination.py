"""Find test items inside documents (operator 3)."""

from __future__ import annotations

import json
from collections import defaultdict

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymill.llm.text import lower_ascii, word_array

SHINGLE_WORDS = 5
PERCENT = 75
# Sketch entries that are sent to the tasks inside the plan; more are joined instead.
MOST_SENT = 1 << 14


def _starts(words: Column, length: int) -> Column:
    return F.when(F.size(words) > 0, F.sequence(F.lit(0), F.greatest(F.size(words) - length, F.lit(0)))).otherwise(
        F.array().cast("array<int>")
    )


def shingles(words: Column, length: int = SHINGLE_WORDS) -> Column:
    """Distinct runs of ``length`` words as strings. Fewer words are one run, none is none."""
    return F.array_distinct(F.transform(_starts(words, length), lambda at: F.array_join(F.slice(words, at + 1, length), " ")))


def shingle_hashes(words: Column, length: int = SHINGLE_WORDS) -> Column:
    """Hashes of the runs, not distinct. Words beyond the end of a short sequence are null and skipped."""
    return F.transform(_starts(words, length), lambda at: F.xxhash64(*[F.get(words, at + k) for k in range(length)]))


def _unnested(frame: DataFrame, column: str, name: str) -> DataFrame:
    """A row for each element of an array column, which goes.

    A filter on the array, or the one that a plain ``explode`` implies, would be pushed below the steps that
    make it, and there evaluate the words of a text once more for each of its words.
    """
    return frame.withColumn(name, F.explode_outer(column)).drop(column).where(F.col(name).isNotNull())


def _sketches(items: DataFrame, percent: int) -> DataFrame:
    """``item, size, class, sketch``: the smallest hashes of each item that a containing document cannot all miss.

    A document that holds ``need`` of the ``size`` shingles misses ``size - need`` at most, so it
    holds one of any ``size - need + 1``. The ones with the smallest hashes are the MinHash sketch of the item.
    Items are partitioned by the power of two below their size; ``class`` is that size.
    """
    hashes = F.array_sort(F.array_distinct(shingle_hashes(F.col("words"))))
    size = F.size("texts")
    need = F.ceil(size * percent / 100)
    return (
        items.where("item_id IS NOT NULL")
        .select(F.col("item_id").alias("item"), word_array(lower_ascii(F.col("text"))).alias("words"))
        .withColumn("texts", shingles(F.col("words")))
        .select(
            "item",
            "texts",
            size.cast("long").alias("size"),
            F.floor(F.log2(size)).cast("int").alias("class"),
            F.slice(hashes, 1, (size - need + 1).cast("int")).alias("sketch"),
        )
    )


def leaks(documents: DataFrame, items: DataFrame, percent: int = PERCENT, most_sent: int = MOST_SENT) -> DataFrame:
    """``doc_id, item_id, n_item, n_found``: items whose shingles a document holds to ``percent`` or more.

    Words are runs without ASCII white space, ``A-Z`` in lower case; shingles are distinct runs of five
    words. An item of fewer words is one shingle of its whole text, which only a document of just these words
    holds. Items without words, items with a null id and null texts match nothing. Repeated documents and
    items give a row for each distinct pair of ids and item size.

    Containment search: items are partitioned by size, and each has a MinHash sketch of just the length
    that no document of sufficient containment can miss (:func:`_sketches`), so that no link is lost. Documents probe
    the sketches of the size classes they are large enough for, on either way. Candidates are verified by exact containment on
    the shingles themselves. The number of sketch entries is counted: up to ``most_sent`` they travel inside the plan, so that
    a document is read once and never shuffled; more are joined by hash. Both ways give the same rows.
    """
    sketches = _sketches(items, percent)
    entries = _unnested(sketches, "sketch", "hash").select("hash", "item", "class").limit(most_sent + 1).collect()
    words = word_array(lower_ascii(F.col("text")))
    probed = documents.select(F.col("doc_id").alias("doc"), words.alias("words"))
    if len(entries) <= most_sent:
        candidates = _probed_in_place(probed, entries, percent)
    else:
        candidates = _probed_by_join(probed, sketches, percent)
    wanted = sketches.select(F.col("item").alias("i"), "texts", "size")
    found = F.size(F.array_intersect("held", "texts")).cast("long")
    return (
        candidates.withColumn("held", shingles(F.col("words")))
        .join(wanted, F.col("item").eqNullSafe(F.col("i")))
        .select(F.col("doc").alias("doc_id"), F.col("item").alias("item_id"), F.col("size").alias("n_item"), found.alias("n_found"))
        .where(F.col("n_found") * 100 >= F.col("n_item") * percent)
        .distinct()
    )


def _large_enough(size_class: Column, percent: int) -> Column:
    """A document holds ``percent`` of an item only if it has that many shingles itself."""
    n_shingles = F.greatest(F.size("words") - SHINGLE_WORDS + 1, F.lit(1)).cast("long")
    return n_shingles * 100 >= F.pow(F.lit(2), size_class) * percent


def _probed_in_place(probed: DataFrame, entries: list, percent: int) -> DataFrame:
    classes, owners = defaultdict(set), defaultdict(set)
    for hashed, item, size_class in entries:
        classes[size_class].add(hashed)
        owners[hashed].add(item)
    if not entries:
        return probed.where(F.lit(False)).withColumn("item", F.lit(None).cast("bigint"))
    listed = lambda hashes: F.split(F.lit(",".join(map(str, sorted(hashes)))), ",").cast("array<bigint>")
    hits = [
        F.when(_large_enough(F.lit(size_class), percent), F.array_intersect("hashes", listed(hashes))).otherwise(
            F.array().cast("array<bigint>")
        )
        for size_class, hashes in sorted(classes.items())
    ]
    owner = F.from_json(F.lit(json.dumps({str(k): sorted(v, key=repr) for k, v in owners.items()})), "map<string,array<bigint>>")
    items_of = F.array_distinct(F.flatten(F.transform("hits", lambda h: F.element_at(owner, h.cast("string")))))
    hit = probed.withColumn("hashes", shingle_hashes(F.col("words"))).select(
        "doc", "words", F.flatten(F.array(*hits)).alias("hits")
    )
    return _unnested(hit.select("doc", "words", items_of.alias("candidates")), "candidates", "item")


def _probed_by_join(probed: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    wanted = _unnested(sketches, "sketch", "hash").select("hash", "item", "class")
    # The largest class that a document may hold items of.
    largest = F.floor(F.log2(F.greatest(F.size("words") - SHINGLE_WORDS + 1, F.lit(1)) * 100 / percent) + 1e-9).cast("int")
    hashes = probed.select("doc", largest.alias("largest"), F.array_distinct(shingle_hashes(F.col("words"))).alias("hashes"))
    found = (
        _unnested(hashes, "hashes", "hash")
        .join(wanted, "hash")
        .where("class <= largest")
        .select(F.col("doc").alias("found"), "item")
        .distinct()
    )
    return probed.join(found, F.col("doc").eqNullSafe(F.col("found"))).select("doc", "words", "item")
