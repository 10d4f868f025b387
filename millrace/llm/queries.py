"""The registered queries of this package, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from millrace.llm import oracles
from millrace.llm.align import align
from millrace.llm.debruijn import remove_repeats
from millrace.llm.decontaminate import contamination
from millrace.llm.html_text import main_text
from millrace.llm.lexical import search
from millrace.llm.maxent import score_texts
from millrace.llm.packing import pack
from millrace.llm.pieces import encode
from millrace.llm.quality import quality_verdicts
from millrace.llm.shared import fold, ship
from millrace.llm.simhash import simhash_components
from millrace.llm.suffix_index import remove_earlier_strings
from millrace.llm.toxicity import learn, toxicity
from millrace.llm.warc import page_captures, resolve_revisits, with_bodies

Query = Callable[[SparkSession, str], DataFrame]

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_simhash_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_components(_table(spark, sf_dir, "documents"), shingle=4, max_bits=4)


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(
        _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), window=10, k=5
    )


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_verdicts(_table(spark, sf_dir, "documents"))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept",
    )


def op4_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text(_table(spark, sf_dir, "pages"), run=8)


def op5_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    scored = score_texts(docs, docs.filter(fold(F.col("doc_id"), 10) != 0))
    return scored.select(
        "doc_id", (fold(F.col("doc_id"), 10) == 0).alias("held_out"), "n_tokens", "n_known",
        "train_tokens", "base_score", "score",
    )


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(_table(spark, sf_dir, "documents"), window=20).drop("spans")


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_earlier_strings(_table(spark, sf_dir, "documents"), length=50)


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(_table(spark, sf_dir, "documents"), TOKENIZER)


def op9_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    captures = page_captures(_table(spark, sf_dir, "pages"))
    resolved = with_bodies(resolve_revisits(captures), captures)
    lines = F.transform(
        F.array_sort(F.map_entries("merged_headers")), lambda e: F.concat_ws(": ", e["key"], e["value"])
    )
    return resolved.select(
        "record_id",
        "canonical_url",
        F.unix_timestamp("captured_at").alias("captured_second"),
        "outcome",
        "response_id",
        F.array_join(lines, "; ").alias("merged_headers"),
        "payload_digest",
        F.coalesce(F.octet_length("body"), F.lit(0)).cast("long").alias("body_bytes"),
        F.sha2("body", 256).alias("body_sha256"),
    )


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    training = docs.select("doc_id", "text").filter(fold(F.col("doc_id"), 3) != 1)
    # One plan at any size: labels grow with the documents, so they are never sent to every task.
    model = learn(training.join(labels.select("doc_id", "toxic").hint("merge"), "doc_id"), row_id="doc_id")
    scored = toxicity(docs, model, threshold=0.7)
    return scored.select(
        "doc_id", (fold(F.col("doc_id"), 3) == 1).alias("held_out"), "score", "predicted", "passages"
    )


def op11_piece_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = encode(_table(spark, sf_dir, "documents"), PIECES, with_decoded=True)
    return encoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        # The ids as one text at once: an array of strings would be an object on the heap for each id.
        F.sha2(F.replace(F.btrim(F.to_json("ids"), F.lit("[]")), F.lit(","), F.lit(" ")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align(_table(spark, sf_dir, "documents"), TOKENIZER, PIECES)


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), k=10)


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_simhash_components,
        op2_decontamination,
        op3_quality_rules,
        op4_html_text,
        op5_lm_scoring,
        op6_substring_dedup,
        op7_suffix_dedup,
        op8_packing,
        op9_warc_revisits,
        op10_toxicity,
        op11_piece_ids,
        op12_token_alignment,
        op13_lexical_search,
    )
}

ORACLE_SQL: dict[str, str] = {
    "op2_decontamination": oracles.CONTAMINATION,
    "op3_quality_rules": oracles.QUALITY,
    "op6_substring_dedup": oracles.SUBSTRINGS,
    "op9_warc_revisits": oracles.REVISITS,
    "op13_lexical_search": oracles.SEARCH,
}
