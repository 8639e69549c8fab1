"""Remove repeated runs of lines across a corpus (operator 4)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WINDOW_LINES = 3


def _lines(text: Column) -> Column:
    """Lines of a text; no text has none, an empty one has an empty line."""
    return F.when(text.isNull(), F.array().cast("array<string>")).otherwise(F.split(text, "\n", -1))


def _keyed(documents: DataFrame) -> DataFrame:
    """``doc`` and ``copy`` identify a document; a null id counts as the smallest."""
    return documents.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))).alias("doc"),
        F.coalesce(F.xxhash64("text"), F.lit(0)).alias("copy"),
        _lines(F.col("text")).alias("lines"),
    )


def line_windows(documents: DataFrame, window: int = WINDOW_LINES) -> DataFrame:
    """``doc, copy, at, h1, h2``: a 128-bit hash of every ``window`` consecutive lines."""
    places = F.when(
        F.size("lines") >= window, F.sequence(F.lit(0), F.size("lines") - window)
    ).otherwise(F.array().cast("array<int>"))
    of = lambda seed: lambda at: F.xxhash64(F.lit(seed), *[F.get("lines", at + k) for k in range(window)])
    hashed = F.transform(places, lambda at: F.struct(of(1)(at).alias("h1"), of(2)(at).alias("h2")))
    return _keyed(documents).select("doc", "copy", F.posexplode(hashed).alias("at", "h")).select("doc", "copy", "at", "h.*")


def covered_lines(documents: DataFrame, window: int = WINDOW_LINES) -> DataFrame:
    """``doc, copy, covered``: line numbers (from 0) covered by a window that occurred before.

    The first occurrence of a window is the one with the smallest document id and line. Occurrences
    are combined before the shuffle; only windows that occur again are joined back, by a sort-merge join that
    splits a window found in a great part of all documents.
    """
    windows = line_windows(documents, window)
    place = F.struct("doc", "copy", "at")
    repeated = windows.groupBy("h1", "h2").agg(F.min(place).alias("first"), F.count("*").alias("n")).where("n > 1")
    later = windows.join(repeated.select("h1", "h2", "first"), ["h1", "h2"]).where(place > F.col("first"))
    covered = F.array_distinct(
        F.flatten(F.transform(F.collect_set("at"), lambda at: F.sequence(at, at + window - 1)))
    )
    return later.groupBy("doc", "copy").agg(covered.alias("covered"))


def line_deduplicated(documents: DataFrame, window: int = WINDOW_LINES) -> DataFrame:
    """All columns of ``documents`` with the ``text`` cleaned, and ``n_lines`` and ``n_removed`` behind them.

    A line goes if it lies in a run of ``window`` equal lines that occurs earlier in the corpus: in a document
    with a smaller id, or further up in the same one. Windows are judged on the input and may overlap; the lines that
    they cover together are removed once. Documents of fewer lines have no window and stay. Null text
    stays null, and a document that loses all of its lines keeps an empty text. Rows that repeat both id and text are
    one document and get the same result; equal ids with different texts are told apart by the text's hash.
    """
    own = [name for name in documents.columns if name not in ("n_lines", "n_removed")]
    # Names that other columns of the input cannot clash with: they are put into one.
    packed = documents.select(
        F.struct(*own).alias("row"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))).alias("doc"),
        F.coalesce(F.xxhash64("text"), F.lit(0)).alias("copy"),
    )
    joined = packed.join(covered_lines(documents, window), ["doc", "copy"], "left")
    lines = _lines(F.col("row.text"))
    kept = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("covered"))
    text = F.when(F.col("covered").isNull(), F.col("row.text")).otherwise(
        F.array_join(F.transform(kept, lambda at: F.get(lines, at)), "\n")
    )
    return joined.withColumn("cleaned", text).select(
        *[(F.col("cleaned") if name == "text" else F.col("row").getField(name)).alias(name) for name in own],
        F.size(lines).cast("long").alias("n_lines"),
        F.coalesce(F.size("covered"), F.lit(0)).cast("long").alias("n_removed"),
    )
