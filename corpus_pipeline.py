"""From raw documents to a training mixture: five stages, each over all that the one before has kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymill.llm import decontamination, jaccard, language, line_dedup, mixing
from tallymill.llm.oracles import ORACLES
from tallymill.llm.tables import load, stored

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
# The share of documents, by hash of the id, that no language model learns from.
HELD_OUT = "crc32(CAST(CAST(doc_id AS STRING) AS BINARY)) % 4 = 2"


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told; a missing label is filled in. Those without a letter go.

    Short texts of unseen words have low scores but are clean, so the score rejects none: the model decides no row, and a
    label that is given stays, even a wrong one.
    """
    model = language.fit(docs.where(f"NOT coalesce({HELD_OUT}, false)"))
    found = language.predicted(docs.select(*COLUMNS), model)
    known = found.where(F.col("lang_pred") != language.UNKNOWN)
    return known.withColumn("lang", F.coalesce("lang", "lang_pred")).select(*COLUMNS)


def remove_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that occurred before; those that have no other line go."""
    cleaned = line_dedup.line_deduplicated(docs.select(*COLUMNS))
    left = (F.col("n_removed") == 0) | (F.col("n_removed") < F.col("n_lines"))
    return cleaned.where(left).withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return jaccard.representatives(docs.select(*COLUMNS))


def remove_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item. They are told apart by id, null or not, and text."""
    keyed = docs.select(*COLUMNS).withColumn("key", F.struct("doc_id", F.xxhash64("text").alias("text_key")))
    leaks = decontamination.leaks(keyed.select(F.col("key").alias("doc_id"), "text"), load(spark, sf_dir, "benchmark"))
    return keyed.join(leaks.select(F.col("doc_id").alias("key")).distinct(), "key", "left_anti").select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mixture takes words from, and how many. They are told apart by id, null or not, and text."""
    keyed = docs.select(*COLUMNS).withColumn("text_key", F.xxhash64("text"))
    mixed = mixing.mixed_sources(keyed, keep=("text_key",)).where("taken > 0")
    taken = mixed.groupBy(F.col("doc_id").alias("id"), F.col("text_key").alias("of_text")).agg(
        F.max("size").alias("size"), F.max("taken").alias("taken")
    )
    same = F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("text_key") == F.col("of_text"))
    return keyed.join(taken, same).select(*COLUMNS, "size", "taken")


STAGES = [
    ("language ID", identify_language),
    ("line dedup", remove_repeated_lines),
    ("n-gram Jaccard join", keep_one_of_each_group),
    ("benchmark decontamination", remove_leaks),
    ("mixing sources to target weights", mix_sources),
]



def _over(sql: str, table: str) -> str:
    """The SQL of an operator over another table than ``documents``."""
    return sql.replace("documents", table)


# The learned model of the first stage decides no row and fills in missing labels. Labels are never missing in the given
# tables, so that SQL can do without it there.
_KEPT_LINES = ORACLES["op4_line_dedup"].replace("sha256(coalesce(t, '')) AS kept_sha256", "coalesce(t, '') AS kept")
ORACLE_SQL = rf"""
WITH lettered AS (
  SELECT doc_id, text, lang, source, n_chars FROM documents WHERE regexp_matches(text, '\p{{L}}')
), lines_of AS ({_over(_KEPT_LINES, "lettered")}
), lined AS (
  SELECT doc_id, CASE WHEN n_removed = 0 THEN text ELSE kept END AS text, lang, source,
    length(CASE WHEN n_removed = 0 THEN text ELSE kept END)::BIGINT AS n_chars
  FROM lettered JOIN lines_of USING (doc_id) WHERE n_removed = 0 OR n_removed < n_lines
), groups_of AS ({_over(ORACLES["op5_jaccard_join"], "lined")}
), single AS (
  SELECT lined.* FROM lined JOIN groups_of USING (doc_id) WHERE doc_id = component_id
), leaks_of AS ({_over(ORACLES["op3_benchmark_leaks"], "single")}
), clean AS (
  SELECT * FROM single ANTI JOIN leaks_of USING (doc_id)
), mix_of AS ({_over(ORACLES["op7_source_mix"], "clean")}
)
SELECT clean.*, size, taken FROM clean JOIN mix_of USING (doc_id) WHERE taken > 0
"""


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each is written to the shared folder and read again by the next."""
    docs = load(spark, sf_dir, "documents")
    for place, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if place < len(STAGES) - 1:
            docs = stored(docs, "stage")
    return docs
