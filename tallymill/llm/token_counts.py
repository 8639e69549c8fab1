"""Token counts of texts by a two-tier table of pre-token lengths (operator 13)."""

from __future__ import annotations

import os
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from tokenizers import Tokenizer

from tallymill.llm.tables import received, shipped
from tallymill.llm.text import SEPARATORS

# Bounds: entries of the shared table and bytes of each, pre-tokens that the sketches follow, pre-tokens that a worker remembers.
FREQUENT = 1 << 16
MOST_BYTES = 64
TRACKED = 1 << 17
REMEMBERED = 1 << 20
# Sketches of tasks are merged by so many tasks, and those by so many.
MERGES = (1024, 32)

LIMIT = 2048


class Shared:
    """What is broadcast: frequent pre-tokens in one string, and their lengths. A worker builds its table of it once
    and keeps that for all its tasks."""

    def __init__(self, tokenizer: str, words: list[bytes], sizes: np.ndarray):
        self.tokenizer, self.words, self.sizes = tokenizer, b" ".join(words), sizes
        self.lengths = None

    def table(self) -> Lengths:
        if self.lengths is None:
            self.lengths = Lengths(self.tokenizer, self.words.split(), self.sizes)
        return self.lengths


class Lengths:
    """Numbers of tokens of pre-tokens: frequent ones stay, others are kept until the table is full.

    A pre-token is a run of bytes without ASCII white space. The tokenizer drops white space, and no token, special
    token or normalization reaches across it, so that the tokens of a text are those of its pre-tokens.
    """

    def __init__(self, tokenizer: str, words: list[bytes], sizes: np.ndarray, remembered: int = REMEMBERED):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark gives every task one core
        self.tokenizer = Tokenizer.from_str(tokenizer)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.frequent = dict(zip(words, sizes.tolist(), strict=True))
        self.most = len(words) + remembered
        self.known = dict(self.frequent)

    def encoded(self, words: list[bytes]) -> list[int]:
        found = self.tokenizer.encode_batch([word.decode("utf-8", "replace") for word in words], add_special_tokens=False)
        return [len(one.ids) for one in found]

    def of(self, text: bytes) -> int:
        """Tokens of a text; what is not known yet is encoded once."""
        words, known = text.split(), self.known
        # Set difference looks its own elements up in a plain dictionary only; it walks through any other mapping.
        unseen = list(set(words).difference(known))
        long = {}
        if unseen:
            found = dict(zip(unseen, self.encoded(unseen), strict=True))
            long = {word: size for word, size in found.items() if len(word) > MOST_BYTES}
            if len(known) + len(found) - len(long) > self.most:
                known.clear()
                known.update(self.frequent)
                # Words of this text may have been forgotten just now.
                gone = list(set(words).difference(known).difference(found))
                found.update(zip(gone, self.encoded(gone), strict=True))
            known.update(found)
        total = sum(map(known.__getitem__, words))
        for word in long:
            del known[word]
        return total


def frequent_words(documents: DataFrame, text: str = "text", most: int = FREQUENT) -> list[str]:
    """The most frequent pre-tokens of all documents, ``most`` at best, of ``MOST_BYTES`` at most each.

    Every task counts its pre-tokens in a sketch of bounded size; only sketches are shuffled, and merged in three
    levels, so that neither the size nor the number of tasks makes one of them large.
    """
    words = documents.select(F.spark_partition_id().alias("part"), F.explode(F.split(text, SEPARATORS)).alias("word"))
    # Equal keys of a task are merged before the shuffle.
    sketches = words.where(f"word <> '' AND octet_length(word) <= {MOST_BYTES}").groupBy(
        F.pmod("part", F.lit(MERGES[0])).alias("part")
    ).agg(F.expr(f"approx_top_k_accumulate(word, {TRACKED})").alias("sketch"))
    combined = F.expr(f"approx_top_k_combine(sketch, {TRACKED})").alias("sketch")
    fewer = sketches.groupBy(F.pmod("part", F.lit(MERGES[1])).alias("part")).agg(combined)
    # Grouped by a constant, no words give no row rather than a sketch of nothing.
    whole = fewer.groupBy(F.lit(0).alias("part")).agg(combined)
    row = whole.select(F.expr(f"approx_top_k_estimate(sketch, {most})").alias("found")).first()
    return [entry["item"] for entry in row["found"]] if row else []


def token_counts(documents: DataFrame, tokenizer_path: str, limit: int = LIMIT, text: str = "text") -> DataFrame:
    """All columns of ``documents``, then ``n_bytes``, ``n_tokens`` and ``over_limit`` (more than ``limit`` tokens).

    ``tokenizer_path`` names a file of the ``tokenizers`` library whose pre-tokenizer drops white space; it is read
    on the driver alone. Counts are those of its ``encode`` of the whole text without begin, end, truncation and
    padding, and with special strings inside texts taken for special tokens, as is its default.

    First tier: a table of the lengths of the most frequent pre-tokens of all documents (:func:`frequent_words`),
    broadcast; it has ``FREQUENT`` entries of ``MOST_BYTES`` at most, some 5 MB. Second tier: each
    worker encodes other pre-tokens when it meets them and remembers ``REMEMBERED`` of them. Pre-tokens are not shuffled.

    Null and empty texts have no bytes and no tokens. Bytes that are not UTF-8 count as they are in ``n_bytes`` and are
    replaced before they are encoded. Repeated rows are rows of their own. Columns of the input by the three names
    are replaced.
    """
    spark = documents.sparkSession
    tokenizer = Path(tokenizer_path).read_text(encoding="utf-8")
    words = [word.encode() for word in frequent_words(documents, text)]
    sizes = Lengths(tokenizer, [], np.empty(0, np.uint8)).encoded(words) if words else []
    shared = shipped(spark, Shared(tokenizer, words, np.array(sizes, np.uint8)))
    added = ("n_bytes", "n_tokens", "over_limit")
    own = [name for name in documents.columns if name not in added]
    frame = documents.select(*own)
    schema = StructType(list(frame.schema.fields)).add("n_bytes", "long").add("n_tokens", "long").add("over_limit", "boolean")

    def count(batches):
        lengths = received(shared).table()
        for batch in batches:
            texts = [value or b"" for value in batch.column(len(own)).to_pylist()]
            tokens = np.fromiter(map(lengths.of, texts), np.int64, len(texts))
            columns = [
                *batch.columns[: len(own)],
                pa.array(map(len, texts), pa.int64()),
                pa.array(tokens),
                pa.array(tokens > limit),
            ]
            yield pa.record_batch(columns, [*own, *added])

    unused = max(own, key=len) + "_bytes"
    return frame.select("*", F.col(text).cast("binary").alias(unused)).mapInArrow(count, schema)
