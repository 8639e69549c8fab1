"""Operator 13 against the library's own counts of whole texts."""

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tallymill.llm import registry, token_counts
from tests.conftest import MEDIUM

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def plain(library, text):
    return len(library.encode(text or "", add_special_tokens=False).ids)


def test_query_equals_the_library(spark, library):
    texts = dict(spark.read.parquet(f"{MEDIUM}/documents.parquet").select("doc_id", "text").collect())
    found = registry.QUERIES["op13_token_counts"](spark, MEDIUM).collect()
    assert len(found) == len(texts)
    for row in found:
        tokens = plain(library, texts[row.doc_id])
        assert (row.n_bytes, row.n_tokens, row.over_limit) == (len((texts[row.doc_id] or "").encode()), tokens, tokens > 2048)


ALPHABET = "aAbzZ09'’.,!<|>_-\t\n\x0b\x0c\r \x1c\x85\xa0 ​　éÉȩ́ΣςİıßſK한가가漢🙂👩‍"


@settings(max_examples=40, deadline=None)
@given(st.lists(st.sampled_from([*ALPHABET, "<|endoftext|>", "<|startoftext|>", "'re", " the "]), max_size=90).map("".join))
def test_pre_tokens_do_not_depend_on_their_surroundings(text):
    library = test_pre_tokens_do_not_depend_on_their_surroundings.library
    lengths = token_counts.Lengths(library.to_str(), [b"the"], np.array([1], np.uint8), remembered=5)
    # A small table forgets on the way, so the second count is of a table in use.
    assert [lengths.of(text.encode()) for _ in range(2)] == [plain(library, text)] * 2


test_pre_tokens_do_not_depend_on_their_surroundings.library = Tokenizer.from_file(PATH)


def test_odd_rows(spark, library):
    long = "x" * 5000 + " " + "wörter " * 3000
    rows = [(1, None), (2, ""), (3, " \n "), (None, "no id"), (5, "same"), (5, "same"), (6, long), (7, "a<|endoftext|>b <|startoftext|>")]
    frame = spark.createDataFrame([(*row, "kept", 9) for row in rows], "doc_id long, text string, __bytes string, n_tokens int")
    found = token_counts.token_counts(frame, PATH, limit=3000).collect()
    assert found[0].asDict().keys() == {"doc_id", "text", "__bytes", "n_bytes", "n_tokens", "over_limit"}
    assert sorted((repr(r.doc_id), r.n_bytes, r.n_tokens, r.over_limit) for r in found) == sorted(
        (repr(key), len((text or "").encode()), plain(library, text), plain(library, text) > 3000) for key, text in rows
    )
    assert all(r["__bytes"] == "kept" for r in found)


def test_bytes_that_are_not_utf8(spark):
    frame = spark.sql("SELECT 1L AS doc_id, cast(X'61FF62' AS string) AS text")
    row = token_counts.token_counts(frame, PATH).select("doc_id", "n_bytes", "n_tokens").first()
    assert row.n_bytes == 3 and row.n_tokens > 0


def test_empty_table(spark):
    frame = spark.createDataFrame([], "doc_id long, text string")
    assert token_counts.token_counts(frame, PATH).collect() == []


def test_frequent_words_cover_all_documents(spark):
    frame = spark.range(20000, numPartitions=7).selectExpr("id AS doc_id", "concat('common  word', id % 100, '\\n', id) AS text")
    found = token_counts.frequent_words(frame, most=1000)
    assert found[0] == "common" and set(found) >= {f"word{n}" for n in range(100)}


def test_nothing_but_sketches_is_shuffled(spark):
    frame = spark.range(10).selectExpr("id AS doc_id", "'a b' AS text")
    plan = token_counts.token_counts(frame, PATH)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
