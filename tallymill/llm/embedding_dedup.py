"""Near-duplicate vectors by searching small-world graphs of all shards (operator 1)."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymill.llm.hnsw import Forest, Graph, unit
from tallymill.llm.tables import components, stored

COSINE = 0.9
# Shards are no fewer, and hold no more values, than this; queries of a shard are dealt to tasks in such portions.
LEAST_SHARDS = 8
SHARD_VALUES = 1 << 22
QUERY_VALUES = 1 << 20
# The recall that the search has to reach, as the mean over audited vectors. These are drawn in rounds until ``LINKED`` of them
# have links outside large groups, or their values are ``AUDIT_VALUES``. So many in large groups are searched.
RECALL = 0.99
LINKED = 300
AUDITED = 512
AUDIT_VALUES = 1 << 19
OF_LARGE = 128
# Vectors with more links than this, and than half of the most links of any, are in large groups.
LARGE = 16
BEAM = 48


def _classes(vectors: DataFrame) -> tuple[DataFrame, DataFrame]:
    """All rows with the key of their class of equal vectors; and a row for each class with its smallest id.

    Vectors of single precision travel as such, half as long; all that is computed of them is in double precision.
    """
    single = vectors.schema["embedding"].dataType.simpleString() == "array<float>"
    values = F.col("embedding").cast("array<double>")
    usable = (
        F.col("vec_id").isNotNull()
        & F.coalesce(F.size("v") > 0, F.lit(False))
        & F.forall("v", lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
        & F.exists("v", lambda x: x != 0)
    )
    # Adding 0.0 makes -0.0 equal to 0.0.
    keyed = (
        vectors.select("vec_id", F.transform(values, lambda x: x + F.lit(0.0)).alias("v"))
        .withColumn("usable", usable)
        .withColumn("k1", F.when(F.col("usable"), F.xxhash64(F.lit(1), "v")))
        .withColumn("k2", F.when(F.col("usable"), F.xxhash64(F.lit(2), "v")))
    )
    classes = (
        keyed.where("usable")
        .groupBy("k1", "k2")
        .agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies"), F.any_value(F.col("v").cast("array<float>") if single else F.col("v")).alias("v"))
        .withColumn("dim", F.size("v"))
    )
    return keyed.select("vec_id", "k1", "k2"), classes


def _matrix(table: pa.Table, dim: int) -> np.ndarray:
    return table["v"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def _built(table: pa.Table) -> pa.Table:
    """The graph of one shard as bytes, with the ids in ascending order and numbers of copies of its nodes."""
    table = table.sort_by("rep")
    dim, shard = table["dim"][0].as_py(), table["shard"][0].as_py()
    graph = Graph.build(_matrix(table, dim), seed=shard)
    data = graph.to_bytes(rep=table["rep"].to_numpy(), copies=table["copies"].to_numpy())
    return pa.table({"dim": pa.array([dim], pa.int32()), "shard": pa.array([shard], pa.int64()), "graph": pa.array([data], pa.binary())})


def _counted(
    graph: Graph,
    own: np.ndarray,
    copies: np.ndarray,
    reps: np.ndarray,
    vectors: np.ndarray,
    planted: np.ndarray,
    least: float,
    beam: int,
    forest: Forest | None = None,
) -> np.ndarray:
    """Links of each query with the nodes ``own``, weighed by their ``copies``; no class links with itself, planted vectors
    with the one whose id they go by. All links go into the ``forest``.

    Of a large group the links are counted as they come, and never held together.
    """
    links = np.zeros(len(reps), np.int64)
    for query, node in graph.matches(vectors, least, beam):
        if node.ndim == 2:
            links[query] += node @ copies
            place = np.searchsorted(own, reps[query])
            rows = np.flatnonzero(np.isin(reps[query], own) & ~planted[query])
            links[query[rows]] -= np.where(node[rows, place[rows]], copies[place[rows]], 0)
            if forest is not None:
                forest.add_marked(query, node)
        else:
            other = planted[query] | (reps[query] != own[node])
            links += np.bincount(query[other], copies[node[other]], len(reps)).astype(np.int64)
            if forest is not None:
                forest.add(query, node)
    return links


def _searcher(beam: int, least: float):
    def search(queries: pa.Table, graphs: pa.Table) -> pa.Table:
        """``a, b, links``: links found of each query (``b`` null), and a forest that connects all that are linked."""
        empty = pa.array([], pa.int64())
        if not len(queries) or not len(graphs):
            return pa.table({"a": empty, "b": empty, "links": empty})
        graph, more = Graph.from_bytes(graphs["graph"][0].as_py())
        reps, own = queries["rep"].to_numpy(), more["rep"]
        forest, vectors = Forest(len(own), len(reps)), _matrix(queries, queries["dim"][0].as_py())
        links = _counted(graph, own, more["copies"], reps, vectors, np.zeros(len(reps), bool), least, beam, forest)
        # A link from everything to the smallest id that it is connected with; a class may be both node and query.
        ids = np.concatenate([own, reps])
        lowest = np.full(len(ids), np.iinfo(np.int64).max)
        np.minimum.at(lowest, forest.root, ids)
        low = lowest[forest.root]
        hung, some = ids != low, links > 0
        pairs = np.unique(np.column_stack([ids[hung], low[hung]]), axis=0)
        return pa.table(
            {
                "a": pa.array(np.concatenate([reps[some], pairs[:, 0]]), pa.int64()),
                "b": pa.concat_arrays([pa.nulls(int(some.sum()), pa.int64()), pa.array(pairs[:, 1], pa.int64())]),
                "links": pa.concat_arrays([pa.array(links[some], pa.int64()), pa.nulls(len(pairs), pa.int64())]),
            }
        )

    return search


def _drawn(classes: DataFrame, begin: float, end: float) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Ids and unit vectors of the classes, by their length, with a hash in this part of its range."""
    steps = 1 << 30
    place = F.pmod(F.xxhash64(F.lit("audit"), "rep"), F.lit(steps))
    table = classes.where((place >= int(begin * steps)) & (place < int(end * steps))).select("rep", "dim", "v").orderBy("rep").toArrow()
    dims = table["dim"].to_numpy()
    parts = {int(dim): table.filter(pa.array(dims == dim)) for dim in np.unique(dims)}
    return {dim: (part["rep"].to_numpy(), unit(_matrix(part, dim).astype(np.float64))) for dim, part in parts.items()}


def _links_of(graphs: DataFrame, sample: dict[int, tuple], least: float, beam: int) -> dict[int, np.ndarray]:
    """How many classes the search links with each vector of the sample; a beam as wide as a shard finds all.

    Of each vector the sample has the id, the values, and whether it is planted and so no class itself.
    """
    spark = graphs.sparkSession
    shared = spark.sparkContext.broadcast(sample)

    def count(table: pa.Table) -> pa.Table:
        dim = table["dim"][0].as_py()
        reps, vectors, planted = shared.value.get(dim, (np.empty(0, np.int64), np.empty((0, dim)), np.empty(0, bool)))
        graph, more = Graph.from_bytes(table["graph"][0].as_py())
        links = _counted(graph, more["rep"], np.ones(len(more["rep"]), np.int64), reps, vectors, planted, least, beam)
        at = np.flatnonzero(links)
        return pa.table({"dim": pa.array(np.full(len(at), dim), pa.int32()), "at": pa.array(at, pa.int64()), "links": pa.array(links[at], pa.int64())})

    found = graphs.groupBy("dim", "shard").applyInArrow(count, "dim int, at long, links long").groupBy("dim", "at").agg(F.sum("links").alias("links"))
    result = {dim: np.zeros(len(reps), np.int64) for dim, (reps, *_) in sample.items()}
    for dim, at, links in found.collect():
        result[dim][at] = links
    shared.destroy()
    return result


def _large(links: dict[int, np.ndarray]) -> dict[int, np.ndarray]:
    most = max((int(n.max()) for n in links.values() if len(n)), default=0)
    return {dim: n > max(LARGE, most / 2) for dim, n in links.items()}


def _planted(sample: dict[int, tuple], usable: dict[int, np.ndarray], wanted: int, least: float) -> dict[int, tuple]:
    """Vectors little closer than ``least`` to sampled ones in random directions, ``wanted`` in all."""
    bases = sum(int(which.sum()) for which in usable.values())
    cosine = least + 0.1 * (1 - least)
    planted = {}
    for dim, (reps, vectors, _) in sample.items():
        at = np.flatnonzero(usable[dim])
        if dim < 2 or not len(at):
            continue
        at = np.resize(at, -(-wanted * len(at) // bases))
        aside = np.random.default_rng(dim).normal(size=(len(at), dim))
        aside = unit(aside - np.einsum("ij,ij->i", aside, vectors[at])[:, None] * vectors[at])
        near = cosine * vectors[at] + np.sqrt(1 - cosine**2) * aside
        planted[dim] = (reps[at], near, np.ones(len(at), bool))
    return planted


def _audited(classes: DataFrame, graphs: DataFrame, least: float, largest: int, total: int, widest: int) -> list[tuple[dict, dict]]:
    """Samples with the true numbers of links of their vectors: those outside large groups, and those in large ones."""
    share, begin, sample, links = min(1.0, AUDITED / total), 0.0, {}, {}
    most = min(1.0, AUDIT_VALUES / (total * widest))
    while True:
        share = min(share, most)
        drawn = {dim: (*part, np.zeros(len(part[0]), bool)) for dim, part in _drawn(classes, begin, share).items()}
        more = _links_of(graphs, drawn, least, largest) if drawn else {}
        for dim, part in drawn.items():
            before = sample.get(dim)
            sample[dim] = part if before is None else tuple(np.concatenate(pair) for pair in zip(before, part, strict=True))
            links[dim] = np.concatenate([links[dim], more[dim]]) if before is not None else more[dim]
        large = _large(links)
        linked = sum(int(((n > 0) & ~large[dim]).sum()) for dim, n in links.items())
        if linked >= LINKED or share >= most:
            break
        begin, share = share, 4 * share
    pick = lambda which: {dim: tuple(values[which[dim]] for values in part) for dim, part in sample.items()}
    small = {dim: (n > 0) & ~large[dim] for dim, n in links.items()}
    in_large = {dim: large[dim] & (np.cumsum(large[dim]) <= OF_LARGE) for dim in links}
    audits = [(pick(which), {dim: links[dim][which[dim]] for dim in links}) for which in (small, in_large)]
    if linked < LINKED:
        planted = _planted(sample, {dim: ~large[dim] for dim in links}, LINKED - linked, least)
        true = _links_of(graphs, planted, least, largest) if planted else {}
        part, of_small = audits[0]
        for dim, new in planted.items():
            part[dim] = tuple(np.concatenate(pair) for pair in zip(part[dim], new, strict=True))
            of_small[dim] = np.concatenate([of_small[dim], true[dim]])
    return audits


def _wide_enough(graphs: DataFrame, audits: list[tuple[dict, dict]], least: float, beam: int, largest: int) -> int:
    """The first doubling of the beam that reaches ``RECALL`` on each of the samples, or one as wide as a shard."""
    for sample, true in audits:
        while beam < largest:
            found = _links_of(graphs, sample, least, beam)
            shares = np.concatenate([found[dim][n > 0] / n[n > 0] for dim, n in true.items()] or [np.ones(0)])
            if not len(shares) or shares.mean() >= RECALL:
                break
            beam *= 2
    return beam


def linked_vectors(vectors: DataFrame, least: float = COSINE, beam: int = BEAM) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for every row of ``vectors`` (``vec_id, embedding``).

    Equal vectors are one class with a number of copies. Classes are dealt to shards by a hash and a navigable small-world
    graph is built of each (a shard holds at most about ``SHARD_VALUES`` numbers). Every class queries
    every shard: it walks the shard's graph with a beam, which widens once if it is full of links; a query that is still full of them
    is compared with the whole shard. Each link found is verified by its cosine in double precision.

    Before that the beam is audited. Classes drawn by a hash are compared with all others by brute force, until ``LINKED`` of
    them have links outside large groups (:data:`LARGE`) or a bounded number is drawn. The mean share of its linked classes that a search
    finds, copies counted once, has to be ``RECALL`` over those outside large groups, and over those in large groups; while it is not, the beam is
    doubled. Where links are too rare for ``LINKED`` such classes, the rest of them are vectors planted near drawn
    ones, just within ``least``. A beam as wide as a shard compares everything.

    Tasks return numbers of links and, of the links themselves, a forest of each shard and portion of queries,
    so that the links within a large group are counted but not stored. Components are united from the forests.

    Vectors that are null, empty, zero, or hold null or non-finite numbers, vectors of different lengths, and rows without an id
    link with nothing. A repeated row is a vector of its own that links with its copies. No rows give none.
    """
    spark = vectors.sparkSession
    rows, classes = _classes(vectors)
    classes = stored(classes, "classes")
    sizes = classes.groupBy("dim").count().collect()
    total = sum(row["count"] for row in sizes)
    if not total:
        return vectors.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")).withColumn(
            "kept", F.col("vec_id").isNotNull()
        )
    plan = [(row["dim"], max(LEAST_SHARDS, -(-row["count"] * row["dim"] // SHARD_VALUES)), -(-row["count"] * row["dim"] // QUERY_VALUES)) for row in sizes]
    plan = spark.createDataFrame(plan, "dim int, shards long, portions long")
    dealt = stored(
        classes.join(plan, "dim")
        .withColumn("shard", F.pmod(F.xxhash64(F.lit("shard"), "rep"), "shards"))
        .withColumn("portion", F.pmod(F.xxhash64(F.lit("portion"), "rep"), "portions")),
        "dealt",
    )
    graphs = stored(dealt.groupBy("dim", "shard").applyInArrow(_built, "dim int, shard long, graph binary"), "graphs")
    key = ["dim", "shard", "portion"]
    copies = graphs.join(plan, "dim").withColumn("portion", F.explode(F.sequence(F.lit(0), F.col("portions") - 1)))
    every = F.explode(F.sequence(F.lit(0), F.col("shards") - 1))
    queries = dealt.select("dim", "portion", "rep", "v", every.alias("shard"))
    largest = dealt.groupBy("dim", "shard").count().agg(F.max("count")).first()[0]
    if beam < largest:
        audits = _audited(classes, graphs, least, largest, total, max(row["dim"] for row in sizes))
        beam = _wide_enough(graphs, audits, least, beam, largest)
    search = _searcher(beam, least)
    found = stored(queries.groupBy(*key).cogroup(copies.groupBy(*key)).applyInArrow(search, "a long, b long, links long"), "found")
    links = found.where("b IS NULL").groupBy(F.col("a").alias("rep")).agg(F.sum("links").alias("links"))
    united = components(found.where("b IS NOT NULL").select("a", "b"), "vectors")
    of_class = (
        classes.select("k1", "k2", "rep", "copies")
        .join(links, "rep", "left")
        .join(united.withColumnRenamed("node", "rep"), "rep", "left")
        .select(
            "k1",
            "k2",
            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            F.coalesce("component", "rep").alias("component_id"),
        )
    )
    return rows.join(of_class, ["k1", "k2"], "left").select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "vec_id").alias("component_id"),
        F.coalesce(F.col("vec_id") == F.coalesce("component_id", "vec_id"), F.lit(False)).alias("kept"),
    )
