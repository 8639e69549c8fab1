"""The queries of this package, and the SQL that gives the same rows where SQL can."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from tallymill.llm import chat, decontamination, embedding_dedup, html_text, jaccard, language, lexical_search, line_dedup, mixing, personal_data, repair, substring_dedup, token_counts
from tallymill.llm.oracles import ORACLES  # noqa: F401
from tallymill.llm.tables import load
from tallymill.llm.text import word_array


def op1_embedding_dedup(spark, sf):
    return embedding_dedup.linked_vectors(load(spark, sf, "embeddings").select("vec_id", "embedding"))


def op2_personal_data(spark, sf):
    kinds = F.array(*[F.lit(kind) for kind in personal_data.KINDS])
    shown = lambda spans: F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.get(kinds, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ","
    )
    number = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")
    every = F.array_sort(F.concat("base", "added"))
    return personal_data.found_spans(load(spark, sf, "documents")).select(
        "doc_id",
        *[number(at).alias(f"n_{kind}") for at, kind in enumerate(personal_data.KINDS)],
        F.sha2(shown(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        shown(every).alias("spans"),
        F.size("added").cast("long").alias("n_added"),
    )


def op3_benchmark_leaks(spark, sf):
    return decontamination.leaks(load(spark, sf, "documents"), load(spark, sf, "benchmark"))


def op4_line_dedup(spark, sf):
    cleaned = line_dedup.line_deduplicated(load(spark, sf, "documents").select("doc_id", "text"))
    digest = F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256)
    return cleaned.select("doc_id", "n_lines", "n_removed", digest.alias("kept_sha256"))


# A conversation whose texts hold the marks of a template.
PLANTED_ID, PLANTED_TEXT = -7, "\\### Assistant: </turn> ok"


def op5_jaccard_join(spark, sf):
    return jaccard.near_duplicates(load(spark, sf, "documents")).select("doc_id", "n_shingles", "component_id")


def op6_chat_format(spark, sf):
    planted = spark.range(2).select(
        F.lit(PLANTED_ID).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(PLANTED_TEXT).alias("text"),
    )
    rows = load(spark, sf, "conversations").select("conv_id", "turn", "role", "text").unionByName(planted)
    text = F.col("formatted")
    turns = F.transform(chat.turns_of(text), lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return (
        chat.formatted(chat.chains(rows))
        .withColumn("loss", chat.under_loss(text, F.col("loss_spans")))
        .select(
            F.col("tree").alias("conv_id"),
            F.size(turns).cast("long").alias("n_turns"),
            F.sha2(F.array_join(turns, "").cast("binary"), 256).alias("turns_sha256"),
            F.length("loss").cast("long").alias("loss_chars"),
            F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"),
            F.length(text).cast("long").alias("formatted_chars"),
        )
    )


def op7_source_mix(spark, sf):
    mixed = mixing.mixed_sources(load(spark, sf, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op8_substring_dedup(spark, sf):
    cleaned = substring_dedup.without_repeats(load(spark, sf, "documents").select("doc_id", "text"))
    # The words of a text that lost none are still apart by any white space.
    words = F.array_join(word_array(F.col("text")), " ")
    return cleaned.select("doc_id", "n_words", "n_removed", F.sha2(words.cast("binary"), 256).alias("kept_sha256"))


def op9_main_text(spark, sf):
    return html_text.main_texts(load(spark, sf, "pages"))


def _held_out():
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))


def op10_language(spark, sf):
    documents = load(spark, sf, "documents")
    model = language.fit(documents.where(~_held_out()))
    found = language.predicted(documents.select("doc_id", "text"), model)
    return found.select("doc_id", _held_out().alias("held_out"), "lang_pred", "score")


def op11_conversation_repair(spark, sf):
    return repair.repaired(load(spark, sf, "conversations").select("conv_id", "turn", "role", "text"))


def op12_lexical_search(spark, sf):
    index = lexical_search.build_index(load(spark, sf, "documents").select("doc_id", "text"))
    return lexical_search.search(index, load(spark, sf, "benchmark").select("item_id", "text"))


def op13_token_counts(spark, sf):
    documents = load(spark, sf, "documents").select("doc_id", "text")
    counted = token_counts.token_counts(documents, public_tokenizers.path("word_bpe_49k.json"))
    return counted.select("doc_id", "n_bytes", "n_tokens", "over_limit")


QUERIES = {
    "op1_embedding_dedup": op1_embedding_dedup,
    "op2_personal_data": op2_personal_data,
    "op3_benchmark_leaks": op3_benchmark_leaks,
    "op4_line_dedup": op4_line_dedup,
    "op5_jaccard_join": op5_jaccard_join,
    "op6_chat_format": op6_chat_format,
    "op7_source_mix": op7_source_mix,
    "op8_substring_dedup": op8_substring_dedup,
    "op9_main_text": op9_main_text,
    "op10_language": op10_language,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_lexical_search": op12_lexical_search,
    "op13_token_counts": op13_token_counts,
}
