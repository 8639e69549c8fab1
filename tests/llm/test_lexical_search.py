"""Operator 12 against scores of all pairs."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from checks import compare
from tallymill.llm import lexical_search, registry
from tests.conftest import MEDIUM

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {ord(letter): letter.lower() for letter in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}


def terms_of(text):
    return TERM.findall((text or "").translate(LOWER))


def plain(documents, items, k=10):
    """``documents`` and ``items`` are lists of (id, text); the results are lists of (id, [(document, score)])."""
    counts = [(key, Counter(terms_of(text))) for key, text in documents]
    counts = [(key, own, sum(own.values())) for key, own in counts if own]
    number, total = len(counts), sum(n for *_, n in counts)
    df = Counter(term for _, own, _ in counts for term in own)
    results = []
    for item, text in items:
        asked, scores = Counter(terms_of(text)), []
        for key, own, n in counts:
            m, score = 100 - 75 + (75 * n * number) // total, 0
            for term, times in asked.items():
                if tf := own.get(term, 0):
                    w = math.floor(1000 * math.log((2 * number + 2) / (2 * df[term] + 1)))
                    score += times * w * ((1000000000 * tf) // (1000 * tf + 8 * m))
            if score > 0:
                scores.append((key, score))
        results.append((item, sorted(scores, key=lambda x: (-x[1], x[0] is None, x[0] or 0))[:k]))
    return results


def found(spark, documents, items, k=10, shard_terms=lexical_search.SHARD_TERMS, parts=3, **options):
    docs = spark.createDataFrame([(*row, "extra", 1) for row in documents], "doc_id long, text string, term string, shard int")
    index = lexical_search.build_index(docs.repartition(parts), shard_terms)
    queries = spark.createDataFrame([(*row, 5) for row in items], "item_id long, text string, query int")
    rows = lexical_search.search(index, queries, k, **options).orderBy("item_id", "rank").collect()
    by_item = {}
    for row in rows:
        by_item.setdefault(row.item_id, []).append((row.rank, row.doc_id, row.score))
    return by_item


def ranked(results):
    return {item: [(at + 1, *one) for at, one in enumerate(best)] for item, best in results if best}


def test_query_equals_its_sql(spark, monkeypatch):
    monkeypatch.setattr(compare, "QUERIES", registry.QUERIES)
    monkeypatch.setattr(compare, "ORACLES", registry.ORACLES)
    assert compare.differences(spark, compare.connect(MEDIUM), MEDIUM, "op12_lexical_search") is None


@pytest.mark.parametrize("shard_terms, query_block, k", [(300, 4, 10), (5000, 256, 3), (1 << 21, 7, 10), (1, 256, 2)])
def test_search_equals_all_pairs(spark, shard_terms, query_block, k):
    pick = random.Random(shard_terms)
    vocabulary = [f"w{at}" for at in range(400)] + ["É", "the", "of", "ñ9"]
    weights = [1 / (at + 1) for at in range(400)] + [1.5, 2, 1, 0.2]
    text = lambda longest: " ".join(pick.choices(vocabulary, weights, k=pick.randint(0, longest)))
    documents = [(at, text(pick.choice([3, 30, 120]))) for at in range(900)]
    # A large group of copies, ties, repeated ids and rows, no text, one long text.
    documents += [(1000 + at, "w7 W9, the w7") for at in range(300)] + [(5, "w3 w399"), (5, "w3 w399"), (6, "w1")]
    documents += [(2000, None), (2001, ""), (2002, "-- !"), (2003, text(20000)), (None, "w398 w399 w397")]
    items = [(at, text(25)) for at in range(20)]
    items += [(50, "w7 w9 W9"), (51, "unseen words"), (52, None), (53, ""), (54, text(3000)), (None, "w398 w12")]
    assert found(spark, documents, items, k, shard_terms, query_block=query_block) == ranked(plain(documents, items, k))


def test_repeated_items_are_ranked_each(spark):
    documents = [(1, "a b"), (2, "a"), (3, "c c c")]
    rows = found(spark, documents, [(7, "a"), (7, "a"), (8, "c")])
    assert sorted(rank for rank, *_ in rows[7]) == [1, 1, 2, 2] and [doc for _, doc, _ in rows[8]] == [3]


def test_empty_tables(spark):
    assert found(spark, [], [(1, "a")]) == {}
    assert found(spark, [(1, "a"), (2, "b")], []) == {}
    assert found(spark, [(1, None), (2, " ")], [(1, "a")]) == {}


def test_blocks_are_rejected_before_they_are_decompressed():
    """Documents that hold just a frequent term are many; few blocks of it are read once rarer terms fill the heap."""
    pick, count = random.Random(1), 20000
    words = [["the"] * pick.randint(1, 3) + (["rare"] if at % 500 == 0 else []) for at in range(count)]
    numbers = {b"the": 0, b"rare": 1}
    coded = [np.array([numbers[w.encode()] for w in own], np.int32) for own in words]
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    schema = to_arrow_schema(StructType.fromDDL(lexical_search._INDEX.format(id="long")))
    rows = [r for b in lexical_search._shard_rows(0, list(range(count)), coded, list(numbers), schema) for r in b.to_pylist()]
    total = sum(map(len, words))
    lists = {r["term"]: lexical_search.Postings(r, w, 10**6, count, total) for r, w in zip(rows, (100, 3000)) if r["term"]}
    whole = rows[-1]
    shard = lexical_search.Shard(whole["docs"], np.array(whole["lengths"]), lists, count, total)
    best = shard.best([(b"the", 1), (b"rare", 1)], 10)
    assert len(best) == 10 and all(doc % 500 == 0 for doc, _ in best)
    assert len(lists[b"the"].lasts) > 150 and len(lists[b"the"].decoded) <= 41


def test_postings_survive_compression():
    values = np.array([0, 1, 127, 128, 16383, 16384, 2**21 - 1, 2**21, 2**28, 2**35 - 1] * 3)
    data, ends = lexical_search.varints(values)
    assert ends[-1] == len(data) and (lexical_search.from_varints(data) == values).all()
    assert len(lexical_search.from_varints(data[:0])) == 0
