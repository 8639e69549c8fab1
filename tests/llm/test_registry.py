"""The registered queries, and the pipeline stage by stage, on the small tables."""

import duckdb
import pytest

import __spark_entry__ as contract
import corpus_pipeline
from checks import compare
from tallymill.llm import registry
from tallymill.llm.tables import stored
from tests.conftest import MEDIUM, SMALL
from tests.llm import brute


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_query_equals_its_sql(spark, monkeypatch, name):
    monkeypatch.setattr(compare, "QUERIES", registry.QUERIES)
    monkeypatch.setattr(compare, "ORACLES", registry.ORACLES)
    assert compare.differences(spark, compare.connect(SMALL), SMALL, name) is None


def test_pipeline_equals_its_sql(spark, monkeypatch):
    monkeypatch.setattr(compare, "QUERIES", {"pipeline": corpus_pipeline.run})
    monkeypatch.setattr(compare, "ORACLES", {"pipeline": corpus_pipeline.ORACLE_SQL})
    assert compare.differences(spark, compare.connect(MEDIUM), MEDIUM, "pipeline") is None


def test_every_operator_is_registered():
    numbers = [int(name[2:].split("_")[0]) for name in registry.QUERIES]
    assert sorted(numbers) == list(range(1, 14))
    # A learned model and a tokenizer are beyond SQL: they are tested on held-out rows and against the library.
    assert registry.QUERIES.keys() - registry.ORACLES.keys() == {"op10_language", "op13_token_counts"}
    assert contract.queries().keys() >= registry.QUERIES.keys() | {"pipeline"}


def documents():
    rows = duckdb.sql(f"SELECT doc_id, text FROM '{SMALL}/documents.parquet'").fetchall()
    return dict(rows)


def test_jaccard_query(spark):
    found = registry.QUERIES["op5_jaccard_join"](spark, SMALL).collect()
    assert {row.doc_id: (row.n_shingles, row.component_id) for row in found} == brute.jaccard_components(documents())


def test_substring_query(spark):
    found = registry.QUERIES["op8_substring_dedup"](spark, SMALL).collect()
    expected = brute.without_passages(documents())
    assert {row.doc_id: (row.n_words, row.n_removed) for row in found} == {key: value[:2] for key, value in expected.items()}


def test_pipeline_equals_plain_stages(spark):
    frame = spark.read.parquet(f"{SMALL}/documents.parquet")
    sources = dict(frame.select("doc_id", "source").collect())
    texts = documents()
    items = dict(duckdb.sql(f"SELECT item_id, text FROM '{SMALL}/benchmark.parquet'").fetchall())
    stages = iter(corpus_pipeline.STAGES)

    def step(docs):
        _, stage = next(stages)
        return stored(stage(spark, docs, SMALL), "stage")

    rows_of = lambda docs: {row.doc_id: row.text for row in docs.select("doc_id", "text").collect()}
    docs = step(frame)
    # Nothing in these tables is without letters.
    assert rows_of(docs) == texts
    docs = step(docs)
    cleaned = brute.without_lines(texts)
    texts = {key: text for key, (lines, gone, text) in cleaned.items() if not gone or gone < lines}
    assert rows_of(docs) == texts
    docs = step(docs)
    texts = {key: texts[key] for key, (_, low) in brute.jaccard_components(texts).items() if key == low}
    assert rows_of(docs) == texts
    docs = step(docs)
    leaked = {key for key, *_ in brute.leaks(texts, items)}
    texts = {key: text for key, text in texts.items() if key not in leaked}
    assert leaked and rows_of(docs) == texts
    mixed = step(docs).collect()
    sizes: dict = {}
    for key, text in texts.items():
        sizes[sources[key]] = sizes.get(sources[key], 0) + len(brute.WORDS.findall(text))
    aims, taken = brute.shared_targets(sizes), {}
    for row in mixed:
        assert texts[row.doc_id] == row.text and 0 < row.taken <= 3 * row["size"]
        taken[row.source] = taken.get(row.source, 0) + row.taken
    for source, aim in aims.items():
        assert abs(taken.get(source, 0) - aim) <= 0.02 * aim + 2 * 128
    assert next(stages, None) is None


def test_pipeline_stages_tell_null_and_repeated_ids_apart(spark):
    item = spark.read.parquet(f"{SMALL}/benchmark.parquet").where("item_id IS NOT NULL AND size(split(text, ' ')) > 10").first().text
    clean = ["clean words " * 100, "some more clean words here " * 60]
    rows = [(key, text, "en", "s", len(text)) for key in (None, 7) for text in (item, *clean)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    left = corpus_pipeline.remove_leaks(spark, docs, SMALL)
    expected = [(key, text) for key in ("7", "None") for text in clean]
    assert sorted((str(r.doc_id), r.text) for r in left.collect()) == expected
    mixed = corpus_pipeline.mix_sources(spark, left, SMALL).collect()
    assert sorted((str(r.doc_id), r.text) for r in mixed) == expected
    assert all(r["size"] == len(r.text.split()) and r.taken == r["size"] for r in mixed)


def test_pipeline_drops_what_has_no_letters(spark):
    rows = [(1, "123 456", None, "s", 7), (2, None, "en", "s", 0)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    labelled = spark.read.parquet(f"{SMALL}/documents.parquet").select(*frame.columns)
    kept = corpus_pipeline.identify_language(spark, labelled.unionByName(frame.selectExpr("-doc_id AS doc_id", *frame.columns[1:])), SMALL)
    assert kept.where("doc_id < 0").count() == 0 and kept.count() == labelled.count()
