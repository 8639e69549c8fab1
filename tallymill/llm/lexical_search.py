"""Ranked lexical search over compressed postings of document shards (operator 12)."""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from tallymill.llm.tables import stored
from tallymill.llm.text import lower_ascii
from tallymill.operators.ranking import first_per_group

# Terms, as code points and as UTF-8 bytes, and the parameters of the score.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_TERM_BYTES = re.compile(rb"[0-9A-Za-z\x80-\xFF]+")
SCALE, TF_PART, LENGTH_PART = 1_000_000_000, 1000, 8
LEAST_LENGTH, LENGTH_SHARE = 25, 75

TOP_K = 10
# Sizes of a shard (a single document may exceed the first), of a block of postings and of a block of queries.
SHARD_TERMS = 1 << 21
SHARD_DOCUMENTS = 1 << 16
BLOCK = 128
QUERY_BLOCK = 256
# Shards with one block of queries that a task scores, about.
CELLS = 2

_INDEX = (
    "shard long, term binary, df long, max_tf long, min_n long, lasts binary, ends binary, tfs binary, ns binary, "
    "data binary, n_docs long, n_terms long, docs array<{id}>, lengths array<long>"
)


# Postings -------------------------------------------------------------------------------------


def varints(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Non-negative integers below 2^35 as bytes with seven bits each, and the end of each in these."""
    sizes = np.ones(len(values), np.int64)
    for bits in (7, 14, 21, 28):
        sizes += values >= 1 << bits
    ends = np.cumsum(sizes)
    out = np.empty(int(ends[-1]) if len(ends) else 0, np.uint8)
    starts = ends - sizes
    for at in range(int(sizes.max(initial=0))):
        some = sizes > at
        low = (values[some] >> (7 * at)) & 127
        out[starts[some] + at] = low | np.where(sizes[some] > at + 1, 128, 0)
    return out, ends


def from_varints(data: np.ndarray) -> np.ndarray:
    if not len(data):
        return np.empty(0, np.int64)
    ends = np.flatnonzero(data < 128)
    if len(ends) == len(data):
        return data.astype(np.int64)
    starts = np.concatenate([[0], ends[:-1] + 1])
    places = np.arange(len(data)) - np.repeat(starts, ends - starts + 1)
    return np.add.reduceat((data & 127).astype(np.int64) << (7 * places), starts)


def impacts(tf: np.ndarray, n: np.ndarray, documents: int, terms: int) -> np.ndarray:
    """What a term's occurrences in a document of ``n`` terms contribute for each unit of the term's weight."""
    length = LEAST_LENGTH + LENGTH_SHARE * n * documents // terms
    return SCALE * tf // (TF_PART * tf + LENGTH_PART * length)


class Postings:
    """A term's documents in a shard, in blocks of ``BLOCK``: by block its last document, the end of its bytes, and the
    highest count and least length in it, which bound its impacts."""

    def __init__(self, row: dict, weight: int, bound: int, documents: int, terms: int):
        self.weight, self.bound = weight, bound
        self.lasts, self.ends = (np.frombuffer(row[name], np.int32) for name in ("lasts", "ends"))
        tfs, ns = (np.frombuffer(row[name], np.int32).astype(np.int64) for name in ("tfs", "ns"))
        self.maxima = impacts(tfs, ns, documents, terms)
        self.data = np.frombuffer(row["data"], np.uint8)
        self.decoded: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def block(self, at: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents and counts of a block, decompressed when it is first asked for."""
        found = self.decoded.get(at)
        if found is None:
            start, base = (self.ends[at - 1], self.lasts[at - 1]) if at else (0, -1)
            pairs = from_varints(self.data[start : self.ends[at]])
            found = self.decoded[at] = base + np.cumsum(pairs[::2]), pairs[1::2]
        return found

    def blocks(self, places) -> tuple[np.ndarray, np.ndarray]:
        parts = [self.block(int(at)) for at in places]
        if len(parts) == 1:
            return parts[0]
        return np.concatenate([docs for docs, _ in parts]), np.concatenate([tfs for _, tfs in parts])

    def places(self, docs: np.ndarray) -> np.ndarray:
        """Block that may hold each document; their number for documents behind the last one."""
        return np.searchsorted(self.lasts, docs)


class Shard:
    """Documents of a shard and the postings of the terms that some queries ask for."""

    def __init__(self, docs: list, lengths: np.ndarray, lists: dict[bytes, Postings], documents: int, terms: int):
        self.docs, self.lengths, self.lists = docs, lengths, lists
        self.documents, self.terms = documents, terms

    def _add(self, scores: np.ndarray, one: Postings, times: int, docs: np.ndarray, tfs: np.ndarray) -> None:
        # A document occurs once in a list.
        scores[docs] += times * one.weight * impacts(tfs, self.lengths[docs], self.documents, self.terms)

    def _complete(self, scores: np.ndarray, lists: list, docs: np.ndarray) -> None:
        """Add what ``lists`` contribute to some documents, reading the blocks that may hold them."""
        for one, times, _ in lists:
            places = np.unique(one.places(docs))
            places = places[places < len(one.lasts)]
            if len(places):
                held, tfs = one.blocks(places)
                asked = np.isin(held, docs, assume_unique=True)
                self._add(scores, one, times, held[asked], tfs[asked])

    def _least(self, scores: np.ndarray, docs: np.ndarray, k: int) -> int:
        """The ``k``-th highest score above 0 of some documents, or 1."""
        values = scores[docs]
        values = values[values > 0]
        return int(np.partition(values, len(values) - k)[len(values) - k]) if len(values) >= k else 1

    def best(self, query: list[tuple[bytes, int]], k: int) -> list[tuple[object, int]]:
        """The ``k`` highest scores above 0 with their documents, lower ids first among equals.

        Lists are in the order of their global bounds. The lower ones whose bounds together stay below the threshold are
        not essential: what occurs in no other list can't get in. The documents of the essential lists are candidates. By the maxima
        of the blocks they would be in, most are rejected before a block of the other lists is decompressed.
        """
        lists = [(self.lists[term], times) for term, times in query if term in self.lists]
        lists = sorted(((one, times, times * one.weight * one.bound) for one, times in lists), key=lambda x: x[2])
        if not lists:
            return []
        scores = np.zeros(len(self.docs), np.int64)
        # The best block of the list with the highest bound gives a first threshold.
        top = lists[-1][0]
        first = np.unique(top.block(int(top.maxima.argmax()))[0])
        self._complete(scores, lists, first)
        least = self._least(scores, first, k)
        scores[first] = 0
        below = np.cumsum([bound for *_, bound in lists])
        essential = int(np.searchsorted(below, least))  # the lists before it sum up to less than the threshold
        for one, times, _ in lists[essential:]:
            self._add(scores, one, times, *one.blocks(range(len(one.lasts))))
        candidates = np.flatnonzero(scores)
        least = max(least, self._least(scores, candidates, k))
        others = lists[:essential][::-1]
        bounds = []
        for one, times, _ in others:
            places = one.places(candidates)
            bounds.append(times * one.weight * np.append(one.maxima, 0)[places])
        if others:
            rest = np.sum(bounds, axis=0)
            for (one, times, _), bound in zip(others, bounds, strict=True):
                alive = np.flatnonzero(scores[candidates] + rest >= least)
                if not len(alive):
                    break
                self._complete(scores, [(one, times, 0)], candidates[alive])
                # The scores now hold what the bound of this list stood for; rejected documents stay rejected.
                rest = rest - bound
                rest[np.setdiff1d(np.arange(len(candidates)), alive, assume_unique=True)] = np.iinfo(np.int64).min // 2
                least = max(least, self._least(scores, candidates[alive], k))
            candidates = candidates[scores[candidates] + rest >= least]
        values = scores[candidates]
        kept = candidates[(values >= least) & (values > 0)]
        found = [(self.docs[at], int(scores[at])) for at in kept]
        return sorted(found, key=lambda x: (-x[1], x[0] is None, x[0]))[:k]


# Index ----------------------------------------------------------------------------------------


def _shard_rows(shard: int, ids: list, words: list[np.ndarray], vocabulary: list[bytes], schema: pa.Schema):
    """Rows of a shard: one for its documents, and one for each term with its postings."""
    lengths = np.array([len(own) for own in words], np.int64)
    # Documents of like length are neighbours, so that their impacts differ little within a block.
    order = np.argsort(lengths, kind="stable")
    lengths = lengths[order]
    docs = [ids[at] for at in order]
    flat = np.concatenate([words[at] for at in order])
    pairs, tfs = np.unique(flat.astype(np.int64) << 32 | np.repeat(np.arange(len(docs)), lengths), return_counts=True)
    terms, places = pairs >> 32, pairs & 0xFFFFFFFF
    starts = np.flatnonzero(np.concatenate([[True], terms[1:] != terms[:-1]]))
    sizes = np.diff(np.append(starts, len(terms)))
    within = np.arange(len(terms)) - np.repeat(starts, sizes)
    gaps = np.where(within == 0, places + 1, places - np.concatenate([[0], places[:-1]]))
    data, ends = varints(np.column_stack([gaps, tfs]).ravel())
    ends = ends[1::2]
    heads = np.flatnonzero(within % BLOCK == 0)
    tails = np.append(heads[1:], len(terms)) - 1
    blocks = -(-sizes // BLOCK)
    before = np.concatenate([[0], ends])[starts]
    edges = np.append(before, len(data))
    highest, shortest = np.maximum.reduceat(tfs, heads), np.minimum.reduceat(lengths[places], heads)
    at = np.concatenate([[0], np.cumsum(blocks)])

    def binary(values: np.ndarray, offsets: np.ndarray) -> pa.Array:
        return pa.Array.from_buffers(
            pa.binary(), len(offsets) - 1, [None, pa.py_buffer(offsets.astype(np.int32).tobytes()), pa.py_buffer(values.tobytes())]
        )

    by_block = lambda values: binary(values.astype(np.int32), 4 * at)
    count = len(starts)
    columns = {
        "shard": pa.array(np.full(count, shard)),
        "term": pa.array([vocabulary[number] for number in terms[starts].tolist()], pa.binary()),
        "df": pa.array(sizes),
        "max_tf": pa.array(np.maximum.reduceat(tfs, starts)),
        "min_n": pa.array(np.minimum.reduceat(lengths[places], starts)),
        "lasts": by_block(places[tails]),
        "ends": by_block(ends[tails] - np.repeat(before, blocks)),
        "tfs": by_block(highest),
        "ns": by_block(shortest),
        "data": binary(data, edges),
    }
    for name in ("n_docs", "n_terms", "docs", "lengths"):
        columns[name] = pa.nulls(count, schema.field(name).type)
    for name in ("lasts", "ends", "tfs", "ns", "data"):
        columns[name] = columns[name].cast(schema.field(name).type)
    table = pa.RecordBatch.from_arrays([columns[field.name] for field in schema], schema=schema)
    for start in range(0, count, 1 << 14):
        yield table.slice(start, 1 << 14)
    whole = {"shard": shard, "n_docs": len(docs), "n_terms": int(lengths.sum()), "docs": docs, "lengths": lengths.tolist()}
    yield pa.RecordBatch.from_pylist([whole], schema)


def build_index(documents: DataFrame, shard_terms: int = SHARD_TERMS) -> DataFrame:
    """An index of ``doc_id, text`` in shards, written to the shared folder.

    Each task cuts its documents into shards of about ``shard_terms`` terms and inverts each of them by itself, so no posting is
    shuffled. A shard has one row for each term with its documents and counts, and one without a term for the ids and
    lengths of its documents. Impacts depend on figures of the whole collection that are not known yet; blocks keep
    the highest count and the least length instead, which bound impacts whatever these figures are. Null texts and those
    without a term are in no shard. Repeated rows are documents of their own.
    """
    frame = documents.select("doc_id", F.col("text").cast("binary").alias("bytes")).where("text IS NOT NULL")
    schema = StructType.fromDDL(_INDEX.format(id=frame.schema["doc_id"].dataType.simpleString()))
    arrow = to_arrow_schema(schema)

    def invert(batches):
        number = TaskContext.get().partitionId() << 32
        ids, words, held = [], [], 0
        numbers: dict[bytes, int] = {}

        def closed():
            vocabulary = list(numbers)
            return _shard_rows(number, ids, words, vocabulary, arrow)

        for batch in batches:
            for doc_id, text in zip(batch["doc_id"].to_pylist(), batch["bytes"].to_pylist(), strict=True):
                found = _TERM_BYTES.findall(text.lower())
                if not found:
                    continue
                ids.append(doc_id)
                for term in set(found).difference(numbers):
                    numbers[term] = len(numbers)
                words.append(np.fromiter(map(numbers.__getitem__, found), np.int32, len(found)))
                held += len(found)
                if held >= shard_terms or len(ids) >= SHARD_DOCUMENTS:
                    yield from closed()
                    ids, words, held = [], [], 0
                    numbers = {}
                    number += 1
        if ids:
            yield from closed()

    return stored(frame.mapInArrow(invert, schema), "lexical-index")


# Search ---------------------------------------------------------------------------------------


def terms_of(text: Column) -> Column:
    return F.regexp_extract_all(lower_ascii(F.coalesce(text, F.lit(""))), F.lit(TERM), F.lit(0))


def search(index: DataFrame, queries: DataFrame, k: int = TOP_K, query_block: int = QUERY_BLOCK) -> DataFrame:
    """The ``k`` best documents for each row of ``queries`` (``item_id, text``).

    ``item_id, rank, doc_id, score``; ranks count from 1 and give the lower id the better rank among equal scores. Only scores
    above 0 are listed. A query without terms, or with none that occurs, has no rows. Rows with one ``item_id`` are
    queries of their own; ids of documents that are null come last among equals.

    Queries go in blocks of ``query_block``. Each shard gets every block, with the postings of its terms alone, and returns
    its ``k`` best for each query; these heaps are cut again in every task before they are merged.
    """
    whole = index.where("term IS NULL")
    sums = whole.agg(F.sum("n_docs").alias("documents"), F.sum("n_terms").alias("terms"), F.count("*").alias("shards")).first()
    documents, terms, shards = sums["documents"] or 0, sums["terms"] or 0, sums["shards"]
    numbered = stored(queries.select("item_id", "text", F.monotonically_increasing_id().alias("query")), "queries")
    parts = max(1, -(-numbered.count() // query_block))
    word = F.explode(terms_of(F.col("text"))).alias("term")
    asked = (
        numbered.select("query", F.pmod(F.xxhash64("query"), F.lit(parts)).cast("int").alias("part"), word)
        .groupBy("part", "query", F.col("term").cast("binary").alias("term"))
        .agg(F.count("*").alias("times"))
    )
    asked = stored(asked, "query-terms")
    # Of each term the weight, and the highest impact that any document can have.
    impact = (SCALE * F.col("max_tf"), TF_PART * F.col("max_tf") + LENGTH_PART * F.col("length"))
    met = (
        index.where("term IS NOT NULL")
        .join(asked.select("term").distinct(), "term", "left_semi")
        .withColumn("length", LEAST_LENGTH + F.expr(f"{LENGTH_SHARE} * min_n * {documents}L div {max(1, terms)}L"))
        .withColumn("impact", F.floor(impact[0] / impact[1]) + 1)
        .groupBy("term")
        .agg(F.sum("df").alias("df"), F.max("impact").alias("bound"))
        .select(
            "term",
            F.floor(1000 * F.log((2 * F.lit(documents) + 2) / (2 * F.col("df") + 1))).cast("long").alias("weight"),
            "bound",
        )
    )
    wanted = stored(asked.select("part", "term").distinct().join(met, "term"), "wanted-terms")
    postings = index.where("term IS NOT NULL").join(wanted, "term").select(
        "shard", "part", "term", "weight", "bound", "lasts", "ends", "tfs", "ns", "data"
    )
    blocks = asked.groupBy("part").agg(F.collect_list(F.struct("query", "term", "times")).alias("asked"))
    # A query set against all shards, in blocks.
    every = F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part")
    cells = whole.select(F.col("shard").alias("cell"), "docs", "lengths", every).join(blocks, "part")
    cells = cells.select("cell", F.col("part").alias("queries"), "docs", "lengths", "asked")
    id_type = index.schema["docs"].dataType.elementType.simpleString()
    schema = StructType.fromDDL(f"query long, doc_id {id_type}, score long")
    arrow = to_arrow_schema(schema)

    def scored(cell: pa.Table, lists: pa.Table) -> pa.Table:
        found = []
        if cell.num_rows and lists.num_rows:
            held = {
                row["term"]: Postings(row, row["weight"], row["bound"], documents, terms)
                for row in lists.select(["term", "weight", "bound", "lasts", "ends", "tfs", "ns", "data"]).to_pylist()
            }
            shard = Shard(cell["docs"][0].as_py(), np.array(cell["lengths"][0].as_py(), np.int64), held, documents, terms)
            by_query: dict[int, list[tuple[bytes, int]]] = {}
            for entry in cell["asked"][0].as_py():
                by_query.setdefault(entry["query"], []).append((entry["term"], entry["times"]))
            for query, own in by_query.items():
                found += [{"query": query, "doc_id": doc, "score": score} for doc, score in shard.best(own, k)]
        return pa.Table.from_pylist(found, arrow)

    # Sized by work: adaptive execution would merge tasks by their few bytes.
    tasks = max(1, -(-shards * parts // CELLS))
    cells, postings = cells.repartition(tasks, "cell", "queries"), postings.repartition(tasks, "shard", "part")
    heaps = cells.groupBy("cell", "queries").cogroup(postings.groupBy("shard", "part")).applyInArrow(scored, schema)
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    best = first_per_group(heaps, ["query"], order, k, "rank")
    return best.join(numbered.select("query", "item_id"), "query").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")
