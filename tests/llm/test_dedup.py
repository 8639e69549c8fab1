"""Operators 1, 5 and 8 against plain versions."""

import random
import time
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from tallymill.llm import embedding_dedup, jaccard, substring_dedup, tables
from tallymill.llm.hnsw import Forest, Graph
from tallymill.llm.tables import components
from tests.llm import brute

NULLS = [(900, None), (901, ""), (902, " \t\n"), (903, "only"), (904, "Only"), (905, "three little words"), (906, "THREE little\nwords")]


def frame(spark, rows):
    documents = spark.createDataFrame(rows, "doc_id long, text string")
    clashing = ("copy", "n", "class", "doc", "spans", "n_removed")
    return documents.selectExpr("*", *(f"'{name}' AS {name}" for name in clashing))


def near_copies(seed, groups=12, copies=8, length=120, change=0.02):
    draw = random.Random(seed)
    words = [f"w{at}" for at in range(400)]
    passage = draw.choices(words, k=70)
    texts = {}
    for group in range(groups):
        base = draw.choices(words, k=draw.choice([3, 30, length]))
        for _ in range(draw.randint(1, copies)):
            text = [draw.choice(words) if draw.random() < change else word for word in base]
            if draw.random() < 0.3:
                text += passage
            texts[len(texts)] = draw.choice([" ", "\n"]).join(text)
    return texts | {len(texts): texts[0]}


@pytest.mark.parametrize(("seed", "leaf", "frequent"), [(1, 16, 16), (2, 2, 16), (3, 2, 1), (4, 1, 2)])
def test_jaccard_groups_equal_brute_force(spark, monkeypatch, seed, leaf, frequent):
    monkeypatch.setattr(jaccard, "FREQUENT", frequent)
    texts = near_copies(seed, change=0.01 * seed) | dict(NULLS)
    found = jaccard.near_duplicates(frame(spark, list(texts.items())), leaf=leaf)
    assert {row.doc_id: (row.n_shingles, row.component_id) for row in found.collect()} == brute.jaccard_components(texts)


def test_one_of_each_group_stays(spark):
    texts = near_copies(5) | dict(NULLS)
    rows = [*texts.items(), (0, texts[0]), (None, "an id is missing in this row of words"), (None, texts[3])]
    kept = jaccard.representatives(frame(spark, rows))
    assert kept.columns == frame(spark, []).columns
    expected = {low for key, (n, low) in brute.jaccard_components(texts).items()}
    found = [row.doc_id for row in kept.collect()]
    assert sorted(key for key in found if key is not None) == sorted(expected)
    assert found.count(None) == 1


def test_jaccard_of_nothing(spark):
    assert jaccard.near_duplicates(frame(spark, [])).count() == 0
    assert {row.component_id for row in jaccard.near_duplicates(frame(spark, NULLS[:3])).collect()} == {900, 901, 902}


def test_large_group_is_joined_around_pivots(spark):
    draw = random.Random(8)
    words = [f"w{at}" for at in range(3000)]
    base = draw.choices(words, k=300)
    texts = {}
    for key in range(150):
        text = list(base)
        text[draw.randrange(300)] = "changed"
        texts[key] = " ".join(text)
    found = jaccard.near_duplicates(frame(spark, list(texts.items()))).collect()
    assert {row.component_id for row in found} == {0}


def test_passages_equal_brute_force(spark):
    texts = near_copies(6, groups=20) | dict(NULLS)
    texts |= {500: texts[4] + " and more", 501: " ".join(["same"] * 300), 502: " ".join(["same"] * 120), 503: " ".join(["same"] * 49)}
    cleaned = substring_dedup.without_repeats(frame(spark, list(texts.items())))
    assert cleaned.columns == ["doc_id", "text", "copy", "n", "class", "doc", "spans", "n_words", "n_removed"]
    found = {row.doc_id: (row.n_words, row.n_removed, brute.WORDS.findall(row.text or "")) for row in cleaned.collect()}
    assert found == brute.without_passages(texts)


@pytest.mark.parametrize("piece", [50, 57, 130])
def test_long_references_are_cut_into_pieces(spark, monkeypatch, piece):
    monkeypatch.setattr(substring_dedup, "PIECE_WORDS", piece)
    draw = random.Random(11)
    long = [f"w{draw.randrange(10**6)}" for _ in range(900)]
    texts = {0: " ".join(long + ["x"] * 10 + long[:80])}
    for key in range(1, 25):
        begin = draw.randrange(850)
        texts[key] = " ".join([f"own{key}", *long[begin : begin + draw.choice([49, 50, 51, 140, 700])], f"end{key}"])
    found = {row.doc_id: row.n_removed for row in substring_dedup.without_repeats(frame(spark, list(texts.items()))).collect()}
    assert found == {key: gone for key, (_, gone, _) in brute.without_passages(texts).items()}


def test_passages_of_many_documents_and_very_long_ones(spark):
    draw = random.Random(7)
    passage = " ".join(str(draw.random()) for _ in range(60))
    texts = {key: f"{draw.random()} {passage} {draw.random()}" for key in range(200)}
    texts[200] = " ".join(str(draw.random()) for _ in range(30_000)) + " " + passage
    cleaned = substring_dedup.without_repeats(frame(spark, list(texts.items())))
    assert {row.doc_id: row.n_removed for row in cleaned.collect()} == {key: 60 * (key > 0) for key in texts}


def test_passages_of_repeated_rows(spark):
    text = " ".join(map(str, range(60)))
    rows = [(1, text), (1, text), (1, text + " x"), (None, text), (2, text)]
    found = substring_dedup.without_repeats(frame(spark, rows)).select("doc_id", "n_removed").collect()
    assert sorted(map(tuple, found), key=repr) == [(1, 60), (1, 60), (1, 60), (2, 60), (None, 0)]
    assert substring_dedup.without_repeats(frame(spark, [])).count() == 0


def test_automaton_finds_all_long_matches():
    draw = random.Random(9)
    for _ in range(300):
        passages = [draw.choices("ab", k=draw.randint(0, 12)) for _ in range(3)]
        words, least = draw.choices("abc", k=draw.randint(0, 25)), draw.randint(1, 5)
        automaton = substring_dedup.Automaton()
        for passage in passages:
            automaton.add(passage)
        known = {tuple(p[at : at + least]) for p in passages for at in range(len(p) - least + 1)}
        covered = {k for at in range(len(words) - least + 1) if tuple(words[at : at + least]) in known for k in range(at, at + least)}
        spans = automaton.spans(words, least)
        assert {k for start, end in spans for k in range(start, end)} == covered
        assert all(a[1] < b[0] for a, b in zip(spans, spans[1:], strict=False))


def vectors_with_groups(seed, groups, size, noise, dim=24):
    draw = np.random.default_rng(seed)
    parts = [draw.normal(size=(150, dim))]
    for _ in range(groups):
        parts.append(draw.normal(size=dim) + noise * draw.normal(size=(size, dim)))
    return np.concatenate(parts)


def expected_links(vectors):
    unit = vectors / np.linalg.norm(vectors, axis=1)[:, None]
    linked = unit @ unit.T >= 0.9
    np.fill_diagonal(linked, False)
    lows = brute.smallest_reachable(range(len(vectors)), zip(*map(np.ndarray.tolist, np.nonzero(linked)), strict=True))
    return {key: (int(linked[key].sum()), low, low == key) for key, low in lows.items()}


@pytest.mark.parametrize(("noise", "size"), [(0.05, 60), (0.33, 30)])
def test_vectors_equal_brute_force(spark, noise, size):
    vectors = vectors_with_groups(1, 5, size, noise)
    vectors = np.concatenate([vectors, vectors[:3], vectors[:3]])
    rows = [(key, vector.tolist(), 1) for key, vector in enumerate(vectors)]
    odd = [(1000, None), (1001, []), (1002, [0.0] * 24), (1003, [None] * 24), (1004, [float("nan")] + [1.0] * 23), (1005, [float("inf")] * 24), (1006, [1.0, 2.0])]
    frame = spark.createDataFrame(rows + [(*row, 2) for row in odd] + [(None, vectors[0].tolist(), 3)], "vec_id long, embedding array<double>, copies int")
    found = {row.vec_id: (row.n_links, row.component_id, row.kept) for row in embedding_dedup.linked_vectors(frame).collect()}
    assert found.pop(None) == (0, None, False)
    for key, _ in odd:
        assert found.pop(key) == (0, key, True)
    expected = expected_links(vectors)
    assert found.keys() == expected.keys()
    assert sum(n for n, *_ in found.values()) >= 0.99 * sum(n for n, *_ in expected.values())
    assert sum(found[key] == expected[key] for key in found) >= 0.98 * len(found)


def test_vectors_of_single_precision_are_compared_in_double(spark):
    vectors = vectors_with_groups(5, 4, 30, 0.33).astype(np.float32)
    frame = spark.createDataFrame([(key, vector.tolist()) for key, vector in enumerate(vectors)], "vec_id long, embedding array<float>")
    found = embedding_dedup.linked_vectors(frame, beam=10**6).collect()
    assert {row.vec_id: (row.n_links, row.component_id, row.kept) for row in found} == expected_links(vectors.astype(np.float64))


def test_no_vectors(spark):
    frame = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert embedding_dedup.linked_vectors(frame).count() == 0


def near_vectors(draw, vectors, cosine):
    unit = vectors / np.linalg.norm(vectors, axis=1)[:, None]
    aside = draw.normal(size=unit.shape)
    aside -= (aside * unit).sum(1)[:, None] * unit
    aside /= np.linalg.norm(aside, axis=1)[:, None]
    return cosine * unit + np.sqrt(1 - cosine**2) * aside


@pytest.mark.parametrize(("alone", "pairs", "hot"), [(2000, 200, 400), (2500, 12, 0)])
def test_pairs_are_found_beside_a_hot_group_and_where_links_are_rare(spark, monkeypatch, alone, pairs, hot):
    monkeypatch.setattr(embedding_dedup, "LEAST_SHARDS", 1)
    draw = np.random.default_rng(4)
    firsts = draw.normal(size=(pairs, 64))
    group = draw.normal(size=64) + 0.02 * draw.normal(size=(hot, 64))
    vectors = np.concatenate([firsts, near_vectors(draw, firsts, 0.91), group, draw.normal(size=(alone, 64))])
    frame = spark.createDataFrame(pa.table({"vec_id": np.arange(len(vectors)), "embedding": list(vectors)}))
    # A beam that is too narrow for pairs, and still finds the links of a hot group by doubling.
    found = {row.vec_id: row.n_links for row in embedding_dedup.linked_vectors(frame, beam=1).where("n_links > 0").collect()}
    assert sum(found.get(key, 0) == 1 for key in range(2 * pairs)) >= 0.98 * 2 * pairs
    assert sum(found.get(2 * pairs + key, 0) for key in range(hot)) >= 0.99 * hot * (hot - 1)


def counts_of(graph, vectors, beam, forest=None):
    own, ones = np.arange(len(graph.vectors)), np.ones(len(graph.vectors), np.int64)
    return embedding_dedup._counted(graph, own, ones, np.arange(len(vectors)), vectors, np.zeros(len(vectors), bool), 0.9, beam, forest)


def test_beams_widen_for_large_groups():
    vectors = vectors_with_groups(3, 1, 400, 0.05)
    counts = counts_of(Graph.build(vectors), vectors, 16)
    assert (counts[150:] >= 396).all() and counts[150:].mean() > 398


@pytest.mark.parametrize("beam", [16, 10_000])
@pytest.mark.parametrize("noise", [0.05, 0.33])
def test_forests_connect_what_is_linked(beam, noise):
    vectors = vectors_with_groups(4, 6, 90, noise)
    forest = Forest(len(vectors), len(vectors))
    links = counts_of(Graph.build(vectors), vectors, beam, forest)
    expected = expected_links(vectors)
    if beam > len(vectors):
        assert links.tolist() == [expected[key][0] for key in range(len(vectors))]
        # Every query links with its own node as well, so the lowest number of a root is that of a node.
        assert forest.root.tolist() == [expected[key][1] for key in range(len(vectors))] * 2


def test_every_row_is_right_when_the_beam_is_the_shard(spark):
    vectors = vectors_with_groups(2, 6, 40, 0.33)
    vectors = np.concatenate([vectors, vectors[:3], vectors[-3:]])
    frame = spark.createDataFrame([(key, vector.tolist()) for key, vector in enumerate(vectors)], "vec_id long, embedding array<double>")
    found = embedding_dedup.linked_vectors(frame, beam=10**6).collect()
    assert {row.vec_id: (row.n_links, row.component_id, row.kept) for row in found} == expected_links(vectors)


def test_a_shard_of_near_copies_takes_seconds():
    draw = np.random.default_rng(6)
    vectors = draw.normal(size=64) + 0.02 * draw.normal(size=(6000, 64))
    graph = Graph.build(vectors)
    started, forest = time.perf_counter(), Forest(6000, 6000)
    tracemalloc.start()
    links = counts_of(graph, vectors, embedding_dedup.BEAM, forest)
    _, most = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert (links == 5999).all() and (forest.root == 0).all()
    assert time.perf_counter() - started < 30 and most < 500e6


def test_components_of_chains_stars_and_pairs(spark):
    draw = random.Random(2)
    links = [(at, at + 1) for at in range(60)] + [(100, at) for at in range(101, 180)] + [(300, 200), (300, 250), (7, 7)]
    draw.shuffle(links)
    links = [link if draw.random() < 0.5 else link[::-1] for link in links]
    found = components(spark.createDataFrame(links, "a long, b long"), "links").collect()
    expected = brute.smallest_reachable({node for link in links for node in link}, links)
    assert {row.node: row.component for row in found} == expected
    assert components(spark.createDataFrame([], "a long, b long"), "links").count() == 0


def test_short_steps_do_not_collect_the_garbage_of_the_driver_each(spark, monkeypatch):
    class Frame:
        collected = 0

        @property
        def sparkSession(self):
            return self

        sparkContext = _jvm = System = sparkSession

        def gc(self):
            Frame.collected += 1

        def inputFiles(self):
            return []

    now = iter([100.0, 100.0, 101.0, 114.0, 116.0, 116.0, 117.0])
    monkeypatch.setattr(tables.time, "monotonic", lambda: next(now))
    monkeypatch.setattr(tables, "_collected", {"at": float("-inf")})
    for expected in (1, 1, 1, 2, 2):
        tables.discard(Frame())
        assert Frame.collected == expected
