"""Exact join of near-duplicate texts in the metric space of shingle sets (operator 5)."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymill.llm.tables import components, discard, stored
from tallymill.llm.text import WORD, distinct, run_hashes, shingle_hashes, word_hashes

SHINGLE_WORDS = 5
PERCENT = 75
# Documents of a region that are compared one with another; larger regions are split by pivots first.
LEAF = 16
# Shingles in more documents than this come last in the order of all shingles, if no more than so many do.
FREQUENT = 16
MOST_FREQUENT = 1 << 20
# One of so many shingles, by hash, finds the frequent passages; around them all shingles are counted.
SLICE = 16
PASSAGE_WORDS = 160
_KNOWN_CLASSES = 1 << 20
# Further shingles of a window make up for those in large regions: one for so many of the set.
SPARE = 16
# Parts of the space of shingles, by hash, whose counts bound a distance from below.
BINS = 512
# Classes that are compared at once where a region joins exhaustively, about.
BLOCK_CLASSES = 256
# Members of a cell that are measured against all that are not yet connected with it, in one round.
HELPERS = 4


def _need(size, percent: int):
    """Shared shingles that the smaller size of any linked pair has at least: its part of ``size``."""
    return -(-size * percent // 100)


def window_length(size: int, percent: int = PERCENT) -> int:
    """How many of a document's first shingles no linked document can all miss.

    A linked document holds at least ``percent`` of them all, so it misses fewer than this; in any fixed order of
    shingles both then have one of their own first ones in common.
    """
    return size - _need(size, percent) + 1 if size else 0


def _reach(size: int, percent: int) -> int:
    """Length of a window with the spare shingles."""
    return min(size, window_length(size, percent) + -(-size // SPARE))


def _class_of(shingles: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(shingles.tobytes(), digest_size=8).digest(), "little", signed=True)


def _signed(values: np.ndarray) -> np.ndarray:
    return values.view(np.int64)


def _lists(arrays: list[np.ndarray]) -> pa.ListArray:
    offsets = np.cumsum([0, *map(len, arrays)])
    values = np.concatenate([np.empty(0, np.int64), *arrays])
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, pa.int64()))


def _described(batches):
    """Of each text: size and class of its shingle set, its counts in the bins, and the slice of it by hash."""
    limit, bits = np.uint64((1 << 64) // SLICE), np.uint64(BINS - 1)
    for batch in batches:
        sizes, classes, slices, bins = [], [], [], []
        for words in word_hashes(batch["text"]):
            shingles = shingle_hashes(words, SHINGLE_WORDS)
            sizes.append(len(shingles))
            classes.append(_class_of(shingles) if len(shingles) else None)
            slices.append(_signed(shingles[: np.searchsorted(shingles, limit)]))
            # Capped counts differ no more than the counts do.
            counts = np.bincount((shingles & bits).astype(np.int64), minlength=BINS)
            bins.append(np.minimum(counts, 255).astype(np.uint8).tobytes() if len(shingles) else None)
        yield pa.record_batch(
            [
                batch["doc_id"],
                batch["copy"],
                pa.array(sizes, pa.int64()),
                pa.array(classes, pa.int64()),
                _lists(slices),
                pa.array(bins, pa.binary()),
            ],
            ["doc_id", "copy", "n", "class", "slice", "bins"],
        )


def _member(values: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Which values are in a sorted table."""
    if not len(table):
        return np.zeros(len(values), bool)
    return table[np.minimum(np.searchsorted(table, values), len(table) - 1)] == values


def _around(shared):
    """Distinct shingles of each text within reach of a frequent one: what may belong to a frequent passage."""

    def run(batches):
        for batch in batches:
            found = []
            for words in word_hashes(batch["text"]):
                runs = run_hashes(words, SHINGLE_WORDS)
                hits = np.flatnonzero(_member(runs, shared.value)) if len(runs) else ()
                if len(hits):
                    edges = np.zeros(len(runs) + 1, np.int64)
                    np.add.at(edges, np.maximum(hits - PASSAGE_WORDS // 2, 0), 1)
                    np.add.at(edges, np.minimum(hits + PASSAGE_WORDS // 2, len(runs)), -1)
                    found.append(distinct(runs[np.cumsum(edges[:-1]) > 0]))
            if found:
                values, counts = np.unique(np.concatenate(found), return_counts=True)
                yield pa.record_batch([pa.array(_signed(values)), pa.array(counts)], ["shingle", "n"])

    return run


def _most_frequent(counts: DataFrame) -> np.ndarray:
    """Sorted shingles of the highest counts: those over ``FREQUENT``, or over the least power-of-two multiple of it
    that leaves ``MOST_FREQUENT`` or fewer, so that the table has a fixed bound."""
    counts = stored(counts.where(F.col("n") > FREQUENT), "frequent")
    level = F.floor(F.log2(F.col("n") / FREQUENT)).cast("int")
    levels = sorted(counts.groupBy(level.alias("level")).count().collect(), reverse=True)
    kept, least = 0, None
    for row in levels:
        if kept + row["count"] > MOST_FREQUENT:
            break
        kept, least = kept + row["count"], row["level"]
    found = counts.where(level >= least).select("shingle").toArrow() if least is not None else None
    discard(counts)
    values = found["shingle"].to_numpy() if found is not None else np.empty(0, np.int64)
    return np.sort(values.astype(np.int64).view(np.uint64))


def _windowed(shared, percent: int):
    """``shingle, class, n``: the first shingles of each text, frequent ones last, else in the order of hashes."""

    def run(batches):
        known = set()
        for batch in batches:
            tokens, classes, sizes = [], [], []
            for words in word_hashes(batch["text"]):
                shingles = shingle_hashes(words, SHINGLE_WORDS)
                if not len(shingles):
                    continue
                own = _class_of(shingles)
                if own in known:
                    continue
                if len(known) >= _KNOWN_CLASSES:
                    known.clear()
                known.add(own)
                frequent = _member(shingles, shared.value)
                window = _reach(len(shingles), percent)
                first = shingles[~frequent][:window]
                if len(first) < window:
                    first = np.concatenate([first, shingles[frequent][: window - len(first)]])
                tokens.append(_signed(first))
                classes.append(np.full(len(first), own, np.int64))
                sizes.append(np.full(len(first), len(shingles), np.int32))
            if tokens:
                yield pa.record_batch(
                    [pa.array(np.concatenate(x)) for x in (tokens, classes, sizes)], ["shingle", "class", "n"]
                )

    return run


def _paired(percent: int, leaf: int):
    """Of rows sorted by shingle and class: pairs within regions of up to ``leaf`` classes, members of larger ones.

    A region is never held: once it has outgrown a leaf, its members pass through.
    """

    def emit(shingle, classes, sizes, starts, ends):
        """Pairs of the small regions ``starts..ends`` as ``a, b, n_a, n_b``."""
        out = []
        lengths = ends - starts
        for length in np.unique(lengths):
            at = starts[lengths == length]
            left, right = np.triu_indices(length, 1)
            a, b = (at[:, None] + left).ravel(), (at[:, None] + right).ravel()
            low, high = np.minimum(sizes[a], sizes[b]), np.maximum(sizes[a], sizes[b])
            near = low.astype(np.int64) * 100 >= high.astype(np.int64) * percent
            out.append((a[near], b[near]))
        return out

    def run(batches):
        rest = None
        for batch in batches:
            columns = [batch[name].to_numpy() for name in ("shingle", "class", "n")]
            if rest is not None:
                columns = [np.concatenate(pair) for pair in zip(rest, columns, strict=True)]
            cut = len(columns[0]) and np.searchsorted(columns[0], columns[0][-1])
            # The last region may go on in the next batch. If it is large already, all but a leaf of it is passed on.
            whole, rest = [c[:cut] for c in columns], [c[cut:] for c in columns]
            yield from finish(whole)
            distinct = np.unique(rest[1], return_index=True)[1]
            if len(rest[0]) > len(distinct):
                rest = [c[distinct] for c in rest]
            if len(distinct) > 4 * leaf:
                yield members(*(c[: -leaf - 1] for c in rest))
                rest = [c[-leaf - 1 :] for c in rest]
        if rest is not None:
            yield from finish(rest)

    def members(shingle, classes, sizes):
        count = len(shingle)
        return pa.record_batch(
            [pa.array(classes), pa.nulls(count, pa.int64()), pa.array(sizes), pa.nulls(count, pa.int32()), pa.array(shingle)],
            ["a", "b", "n_a", "n_b", "region"],
        )

    def finish(columns):
        shingle, classes, sizes = columns
        if not len(shingle):
            return
        fresh = np.r_[True, (shingle[1:] != shingle[:-1]) | (classes[1:] != classes[:-1])]
        shingle, classes, sizes = shingle[fresh], classes[fresh], sizes[fresh]
        starts = np.flatnonzero(np.r_[True, shingle[1:] != shingle[:-1]])
        ends = np.r_[starts[1:], len(shingle)]
        small = (ends - starts > 1) & (ends - starts <= leaf)
        parts = emit(shingle, classes, sizes, starts[small], ends[small])
        if parts:
            a, b = (np.concatenate([part[side] for part in parts]) for side in (0, 1))
            if len(a):
                yield pa.record_batch(
                    [
                        pa.array(classes[a]),
                        pa.array(classes[b]),
                        pa.array(sizes[a]),
                        pa.array(sizes[b]),
                        pa.nulls(len(a), pa.int64()),
                    ],
                    ["a", "b", "n_a", "n_b", "region"],
                )
        large = ends - starts > leaf
        if large.any():
            at = np.concatenate([np.arange(s, e) for s, e in zip(starts[large], ends[large], strict=True)])
            yield members(shingle[at], classes[at], sizes[at])

    return run


def _bounded(batches):
    """The least distance that the counts in the bins allow a pair of sets.

    Sets that differ in ``s`` shingles are at the distance ``1 - (n_a + n_b - s) / (n_a + n_b + s)``. By the triangle
    inequality in each bin, ``s`` is no less than the counts differ in all.
    """
    for batch in batches:
        left, right = (
            np.frombuffer(b"".join(batch[name].to_pylist()), np.uint8).reshape(-1, BINS).astype(np.int16)
            for name in ("bins_a", "bins_b")
        )
        apart = np.abs(left - right).sum(axis=1)
        total = batch["n_a"].to_numpy().astype(np.int64) + batch["n_b"].to_numpy()
        low = 1 - (total - apart) / (total + apart)
        yield pa.record_batch([*(batch[name] for name in ("a", "b", "n_a", "n_b")), pa.array(low)], ["a", "b", "n_a", "n_b", "low"])


def _shared(batches):
    """Shared shingles of pairs of texts."""
    for batch in batches:
        counts, classes = [], batch["a"].to_numpy()
        # The text of a class is looked up once for rows that follow each other.
        fresh = np.ones(len(classes), bool)
        np.not_equal(classes[1:], classes[:-1], out=fresh[1:])
        lefts = word_hashes(batch["text_a"].filter(pa.array(fresh)))
        for first, right in zip(fresh, word_hashes(batch["text_b"]), strict=True):
            if first:
                left = shingle_hashes(next(lefts), SHINGLE_WORDS)
            counts.append(int(_member(shingle_hashes(right, SHINGLE_WORDS), left).sum()))
        yield pa.record_batch([*(batch[name] for name in ("a", "b", "n_a", "n_b")), pa.array(counts, pa.int64())], ["a", "b", "n_a", "n_b", "shared"])


def _measured(pairs: DataFrame, texts: DataFrame, places: DataFrame, percent: int) -> DataFrame:
    """``a, b, d, linked``: Jaccard distances of pairs of classes ``a, b, n_a, n_b``, as a table.

    A pair that the bins show to be too far apart has the bound as its ``d``. The others are measured on their texts, and only
    those are looked up, one of each class.
    """
    radius = 1 - percent / 100
    sides = pairs.select("a", "b", "n_a", "n_b").distinct()
    for side in ("a", "b"):
        sides = sides.join(places.select(F.col("class").alias(side), F.col("bins").alias(f"bins_{side}")), side)
    bounded = stored(
        sides.select("a", "b", "n_a", "n_b", "bins_a", "bins_b").mapInArrow(_bounded, "a long, b long, n_a int, n_b int, low double"),
        "bounded",
    )
    near = bounded.where(F.col("low") <= radius + 1e-9)
    wanted = near.select(F.explode(F.array("a", "b")).alias("class")).distinct()
    placed = places.join(wanted, "class")
    same = F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("copy") == F.col("c"))
    found = stored(
        texts.join(placed.select("class", F.col("doc_id").alias("d"), F.col("copy").alias("c")), same)
        .select("class", "text")
        .dropDuplicates(["class"]),
        "texts",
    )
    for side in ("a", "b"):
        near = near.join(found.select(F.col("class").alias(side), F.col("text").alias(f"text_{side}")), side)
    shared = near.select("a", "b", "n_a", "n_b", "text_a", "text_b").mapInArrow(
        _shared, "a long, b long, n_a int, n_b int, shared long"
    )
    union = F.col("n_a") + F.col("n_b") - F.col("shared")
    measured = shared.select("a", "b", (1 - F.col("shared") / union).alias("d"), (F.col("shared") * 100 >= union * percent).alias("linked"))
    far = bounded.where(F.col("low") > radius + 1e-9).select("a", "b", F.col("low").alias("d"), F.lit(False).alias("linked"))
    result = stored(measured.unionAll(far), "distances")
    discard(bounded, found)
    return result


def _compared(percent: int):
    """Pairs of two blocks of a region that neither sizes, windows nor bins keep apart."""
    radius = 1 - percent / 100

    def run(batches):
        for batch in batches:
            rows = zip(*(batch[name].to_pylist() for name in ("block_1", "block_2", "same")), strict=True)
            for one, two, same in rows:
                (a, n, crowded, d, inside, known, bins), (a2, n2, crowded2, d2, inside2, known2, bins2) = (
                    (
                        np.array([x["a"] for x in block]),
                        np.array([x["n_a"] for x in block], np.int64),
                        np.array([x["crowded"] for x in block]),
                        np.array([x["d"] for x in block]),
                        np.array([x["inside"] for x in block]),
                        np.array([x["connected"] for x in block]),
                        np.frombuffer(b"".join(x["bins"] for x in block), np.uint8).reshape(-1, BINS).astype(np.int16),
                    )
                    for block in (one, two)
                )
                for at in range(len(a)):
                    total = n[at] + n2
                    # The distance to the pivot is exact within the ball, and no less than known outside of it.
                    apart = inside2 & (d[at] - d2 > radius + 1e-9)
                    if inside[at]:
                        apart |= d2 - d[at] > radius + 1e-9
                    if known[at]:
                        apart |= known2
                    good = ~apart & (np.minimum(n[at], n2) * 100 >= np.maximum(n[at], n2) * percent) & (crowded2 | crowded[at])
                    if same:
                        good &= a2 > a[at]
                    left = np.flatnonzero(good)
                    if len(left):
                        differ = np.abs(bins2[left] - bins[at]).sum(axis=1)
                        left = left[differ * (100 + percent) <= total[left] * (100 - percent)]
                    if len(left):
                        yield pa.record_batch(
                            [
                                pa.array(np.full(len(left), a[at])),
                                pa.array(a2[left]),
                                pa.array(np.full(len(left), n[at], np.int32)),
                                pa.array(n2[left].astype(np.int32)),
                            ],
                            ["a", "b", "n_a", "n_b"],
                        )

    return run


def _exhausted(members: DataFrame, places: DataFrame, percent: int) -> DataFrame:
    """Candidate pairs ``a, b, n_a, n_b`` of each region, compared block by block; only near pairs become rows."""
    block = F.pmod(F.xxhash64("a"), F.ceil(F.col("now") / BLOCK_CLASSES)).cast("int")
    entry = F.struct("a", "n_a", "crowded", "d", "inside", "connected", "bins")
    blocks = stored(
        members.join(places.select(F.col("class").alias("a"), "bins"), "a")
        .groupBy("region", block.alias("block"))
        .agg(F.collect_list(entry).alias("entries")),
        "blocks",
    )
    one, two = (blocks.select("region", F.col("block").alias(f"b_{s}"), F.col("entries").alias(f"block_{s}")) for s in (1, 2))
    both = one.join(two, "region").where("b_1 <= b_2").select("block_1", "block_2", (F.col("b_1") == F.col("b_2")).alias("same"))
    # Spread, because the work is in the comparing and not in the bytes.
    tasks = members.sparkSession.sparkContext.defaultParallelism
    found = stored(both.repartition(4 * tasks).mapInArrow(_compared(percent), "a long, b long, n_a int, n_b int").distinct(), "near")
    discard(blocks)
    return found


def _connected(placed: DataFrame, measure, percent: int, links: list[DataFrame]) -> DataFrame:
    """Mark further members of each cell as connected with its pivot, through links to some that are already.

    A few connected members, chosen anew by a hash in every round, are measured against all that are not, as long as
    that connects a fifth of them. In a dense group hardly any is left to be compared with the whole of it.
    """
    radius = 1 - percent / 100
    number, before = 0, placed.where("NOT connected").count()
    while before:
        chosen = [
            F.min(F.struct(F.xxhash64("a", F.lit(number * HELPERS + at)).alias("h"), "a", "n_a", "d", "inside")) for at in range(HELPERS)
        ]
        helpers = placed.where("connected").groupBy("region").agg(F.array_distinct(F.array(*chosen)).alias("q"))
        asked = placed.where("NOT connected").join(helpers.select("region", F.explode("q").alias("q")), "region")
        asked = asked.where(
            (F.least("n_a", "q.n_a") * 100 >= F.greatest("n_a", "q.n_a") * percent)
            & (~F.col("q.inside") | (F.col("d") - F.col("q.d") <= radius + 1e-9))
        )
        asked = stored(
            asked.select("region", F.col("q.a").alias("a"), F.col("a").alias("b"), F.col("q.n_a").alias("n_a"), F.col("n_a").alias("n_b")),
            "asked",
        )
        linked = measure(asked).where("linked").select("a", "b")
        links.append(linked)
        hits = asked.join(linked, ["a", "b"]).select("region", F.col("b").alias("a"), F.lit(True).alias("hit")).distinct()
        following = stored(
            placed.join(hits, ["region", "a"], "left")
            .withColumn("connected", F.col("connected") | F.coalesce("hit", F.lit(False)))
            .drop("hit"),
            "placed",
        )
        discard(placed, asked)
        placed, number, after = following, number + 1, following.where("NOT connected").count()
        if 5 * (before - after) < before:
            break
        before = after
    return placed


def _by_pivots(members: DataFrame, places: DataFrame, measure, percent: int, leaf: int) -> DataFrame:
    """Links ``a, b`` of crowded classes within regions too large for a leaf: rows ``region, a, n_a, crowded, heavy``.

    A pivot is taken in each region, the crowded member with most shingles in large regions, and regions of the same pivot become
    one, its Voronoi cell. The distances of all members to it are measured. Those within the radius are its ball: they are linked
    through it and need not be compared with each other, and so are others through them (:func:`_connected`). What lies
    outside goes on as a region of its own, together
    with the boundary: members of the ball from which some outsider may be within the radius by the triangle
    inequality. A region joins exhaustively, block by block and under the windows of the same inequality (:func:`_compared`),
    as soon as it is a leaf or a pivot no longer halves it.
    """
    radius = 1 - percent / 100
    fits = lambda x, y: F.least(x, y) * 100 >= F.greatest(x, y) * percent
    links = []
    left = stored(members.select("region", "a", "n_a", "crowded", "heavy"), "region")
    while not left.isEmpty():
        pivots = left.groupBy("region").agg(F.min(F.struct(~F.col("crowded"), -F.col("heavy"), "n_a", "a")).alias("p"))
        pivots = pivots.select("region", F.col("p.a").alias("pivot"), F.col("p.n_a").alias("n_p"))
        cells = stored(
            left.join(pivots, "region").select(F.col("pivot").alias("region"), "n_p", "a", "n_a", "crowded", "heavy").distinct(), "cells"
        )
        sizes = cells.groupBy("region").agg(F.count("*").alias("size"))
        others = cells.where("a <> region")
        pairs = others.where(fits(F.col("n_a"), F.col("n_p"))).select(
            F.col("region").alias("a"), F.col("a").alias("b"), F.col("n_p").alias("n_a"), F.col("n_a").alias("n_b")
        )
        measured = measure(pairs)
        links.append(measured.where("linked").select("a", "b"))
        known = measured.select(F.col("a").alias("region"), F.col("b").alias("a"), "d", "linked")
        # Sizes alone are a lower bound of the distances that are not measured.
        bound = 1 - F.least("n_a", "n_p") / F.greatest("n_a", "n_p")
        placed = stored(
            others.join(known, ["region", "a"], "left")
            .join(sizes, "region")
            .select(
                "region",
                "a",
                "n_a",
                "crowded",
                "heavy",
                "size",
                F.coalesce("d", bound).alias("d"),
                F.coalesce("linked", F.lit(False)).alias("inside"),
                F.coalesce("linked", F.lit(False)).alias("connected"),
            ),
            "placed",
        )
        placed = _connected(placed, measure, percent, links)
        outside = placed.where("NOT connected").groupBy("region").agg(F.min("d").alias("nearest"))
        kept = placed.join(outside, "region").where(~F.col("inside") | (F.col("d") >= F.col("nearest") - radius - 1e-9))
        now = kept.groupBy("region").agg(F.count("*").alias("now"), F.max("crowded").alias("any")).where("any AND now > 1")
        kept = stored(kept.join(now, "region").drop("nearest", "any"), "kept")
        final = (F.col("now") <= leaf) | (F.col("now") * 2 > F.col("size"))
        measured = measure(_exhausted(kept.where(final), places, percent))
        links.append(measured.where("linked").select("a", "b"))
        discard(left, cells, placed)
        left = stored(kept.where(~final).select("region", "a", "n_a", "crowded", "heavy"), "region")
        discard(kept)
    result = links[0] if links else members.select("a", F.col("a").alias("b")).where(F.lit(False))
    for more in links[1:]:
        result = result.unionAll(more)
    return result


def near_duplicates(documents: DataFrame, percent: int = PERCENT, leaf: int = LEAF) -> DataFrame:
    """``doc_id, copy, n_shingles, component_id, group``: groups of documents connected by ``percent`` common shingles.

    Words are runs without ASCII white space, ``A-Z`` in lower case. A document's set are the 64-bit hashes
    of its distinct runs of five words; fewer words are one run. Two documents link if 100 times their common shingles are at
    least ``percent`` times those of both. Without words or text a document links with nothing. ``component_id`` is the smallest
    id that links lead to and ``group`` a number that the documents of a component share, null without words. Each row gives one row, repeated rows belong together, and ``copy`` (a hash of the text)
    tells rows of the same id apart. A null id is returned as it is and never names a component of others.

    1. Documents of equal sets are one class.
    2. Regions: every class is replicated to the regions of the first shingles of its set, just as many as make
       sure that two linked classes meet (:func:`window_length`), and some to spare. Frequent shingles come last in the order,
       so regions of passages that many documents share hold only documents that have little else. The order changes the
       work, not the result.
    3. A region of up to ``leaf`` classes is joined as it is. A pair goes on only if the shingles that it was found
       by, and all that it may have beyond its windows, can make a link.
    4. A class whose spare shingles make up for those in larger regions is found by its other regions. Regions with
       a crowded class, one that has more of them, are split recursively around pivots, with the windows of the
       triangle inequality (:func:`_by_pivots`).
    5. Distances are bounded by fixed pivots (:func:`_bounded`), and what is left is measured on the texts. Components are
       united over the links.
    """
    spark = documents.sparkSession
    texts = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.xxhash64("text"), F.lit(0)).alias("copy"),
        F.col("text").cast("binary").alias("text"),
    )
    sets = stored(
        texts.mapInArrow(_described, "doc_id bigint, copy bigint, n bigint, class bigint, slice array<bigint>, bins binary"), "sets"
    )
    first = F.min(F.struct("doc_id", "copy")).alias("p")
    places = stored(
        sets.where("class IS NOT NULL").groupBy("class").agg(first, F.any_value("bins").alias("bins")).select("class", "p.*", "bins"),
        "places",
    )
    frequent = _frequent_shingles(sets, texts)
    windows = texts.select("text").mapInArrow(
        _windowed(spark.sparkContext.broadcast(frequent), percent), "shingle long, class long, n int"
    )
    regions = stored(
        windows.repartition("shingle")
        .sortWithinPartitions("shingle", "class")
        .mapInArrow(_paired(percent, leaf), "a long, b long, n_a int, n_b int, region long"),
        "regions",
    )
    del windows
    measure = lambda pairs: _measured(pairs, texts, places, percent)
    large = regions.where("region IS NOT NULL")
    spare = F.ceil(F.col("n_a") / SPARE)
    counts = stored(large.groupBy("a").agg(F.count("*").alias("found"), (F.count("*") > F.first(spare)).alias("crowded")), "crowded")
    met = regions.where("region IS NULL").groupBy("a", "b").agg(
        F.count("*").alias("met"), F.first("n_a").alias("n_a"), F.first("n_b").alias("n_b")
    )
    beyond = lambda n: F.greatest(F.ceil(F.col(n) * percent / 100) - 1 - F.ceil(F.col(n) / SPARE), F.lit(0))
    most = F.col("met") + F.least(F.coalesce("c_a", F.lit(0)), F.coalesce("c_b", F.lit(0))) + F.greatest(beyond("n_a"), beyond("n_b"))
    total = F.col("n_a") + F.col("n_b")
    possible = (
        met.join(counts.select("a", F.col("found").alias("c_a")), "a", "left")
        .join(counts.select(F.col("a").alias("b"), F.col("found").alias("c_b")), "b", "left")
        .where(most * (100 + percent) >= total * percent)
    )
    members = large.select("region", "a", "n_a").join(counts, "a").withColumn("heavy", F.col("found") / F.col("n_a"))
    wanted = members.where("crowded").select("region").distinct()
    links = measure(possible).where("linked").select("a", "b").unionAll(
        _by_pivots(members.join(wanted, "region"), places, measure, percent, leaf)
    )
    united = components(links, "texts")
    discard(regions, counts)
    named = sets.select("doc_id", "copy", "n", "class").join(united.withColumnRenamed("node", "class"), "class", "left")
    named = named.withColumn("group", F.coalesce("component", "class"))
    lowest = named.where("group IS NOT NULL").groupBy("group").agg(F.min("doc_id").alias("low"))
    return named.join(lowest, "group", "left").select(
        "doc_id",
        "copy",
        F.col("n").alias("n_shingles"),
        F.when(F.col("doc_id").isNotNull(), F.coalesce("low", "doc_id")).alias("component_id"),
        "group",
    )


def _frequent_shingles(sets: DataFrame, texts: DataFrame) -> np.ndarray:
    """Shingles that come last in the order: counted in a slice by hash, and then around what is frequent there.

    Copies count each, which changes the order only.
    """
    seen = sets.select(F.explode("slice").alias("shingle"))
    first = _most_frequent(seen.groupBy("shingle").agg(F.count("*").alias("n")))
    if not len(first):
        return first
    near = texts.select("text").mapInArrow(_around(sets.sparkSession.sparkContext.broadcast(first)), "shingle long, n long")
    return np.union1d(first, _most_frequent(near.groupBy("shingle").agg(F.sum("n").alias("n"))))


def representatives(documents: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The rows of ``documents`` with one of each group of :func:`near_duplicates`: the smallest id, then ``copy``.

    Rows that repeat id and text are one document. Documents without words stay, and so do columns and their names.
    """
    found = stored(near_duplicates(documents, percent).where("group IS NOT NULL"), "groups")
    lowest = found.groupBy("group").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "copy")).alias("first"))
    kept = lowest.select(F.col("first.doc_id").alias("d"), F.col("first.copy").alias("c"))
    own = documents.columns
    packed = documents.select(
        F.struct(*own).alias("row"),
        F.col("doc_id").alias("id"),
        F.coalesce(F.xxhash64("text"), F.lit(0)).alias("copy"),
        F.coalesce(F.col("text").rlike(WORD), F.lit(False)).alias("worded"),
    )
    same = F.col("id").eqNullSafe(F.col("d")) & (F.col("copy") == F.col("c"))
    joined = packed.join(kept, same, "left").where(~F.col("worded") | F.col("c").isNotNull())
    return joined.dropDuplicates(["id", "copy"]).select("row.*")
