"""Registered queries of the training-data operators, with DuckDB SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline

from . import (
    align, chat, decontaminate, line_dedup, near_dedup, oracles, pieces, quality_model, quality_rules, repair, span_dedup, toxicity,
    url_filter, warc,
)
from .stage import table

BYTE_BPE_PATH = "/opt/tokenizers/byte_bpe_50k.json"

LLM_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
LLM_ORACLE: dict[str, str] = {}


def _query(name: str, sql: str | None = None):
    def deco(fn):
        LLM_QUERIES[name] = fn
        if sql is not None:
            LLM_ORACLE[name] = sql
        return fn
    return deco


@_query("op1_sentencepiece")
def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Piece ids of every document under seeded merge-dropout, decoded again and compared with the text."""
    model = pieces.read_model(corpus_pipeline.MODEL_PATH)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = pieces.encode(docs, model, check_col="lossless")
    return out.select("doc_id", "pieces", F.size("pieces").cast("long").alias("n_pieces"), "lossless")


@_query("op2_line_dedup", oracles.OP2)
def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of every document that an earlier line equals, or is one edit away from."""
    out = line_dedup.line_report(table(spark, sf_dir, "documents"))
    return out.select(F.col("id").alias("doc_id"), "n_lines", F.size("removed").cast("long").alias("n_removed"), "n_near",
                      F.array_join(F.transform("removed", lambda x: x.cast("string")), ",").alias("removed_lines"))


@_query("op3_minhash_dedup", oracles.OP3)
def op3_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate class of every document: 5-word shingles, similarity 0.85 or more."""
    out = near_dedup.near_duplicate_classes(table(spark, sf_dir, "documents"))
    return out.select(F.col("id").alias("doc_id"), "n_shingles", F.col("component").alias("component_id"),
                      (F.col("id") == F.col("component")).alias("kept"))


@_query("op4_substring_dedup")
def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the sentence pieces that repeat an earlier passage."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return span_dedup.dedup_spans(docs).select("doc_id", "n_pieces", "n_removed", "cut_words", "cut_spans", "text")


@_query("op5_chat_format", oracles.OP5)
def op5_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Formatted conversations, read back; conversation -7 holds control strings."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    hard = r"\### Assistant: </turn> ok"
    probe = spark.createDataFrame([(-7, 0, "user", hard), (-7, 1, "assistant", hard)], "conv_id long, turn long, role string, text string")
    return chat.digest_conversations(chat.format_conversations(turns.unionByName(probe)))


@_query("op6_decontamination", oracles.OP6)
def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document inside 13-word windows of benchmark items."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = decontaminate.find_overlaps(docs, table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                      F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"),
                      decontaminate.contaminated().alias("contaminated"))


@_query("op7_toxicity")
def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Noisy-or toxicity of every document, fitted on the labelled rows outside the held-out fold."""
    out = toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return out.select(F.col("id").alias("doc_id"), toxicity.held_out("id").alias("held_out"), "score",
                      (F.col("score") >= 0.3).cast("int").alias("predicted"), "n_sentences", "offending")


@_query("op8_quality_classifier")
def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document by the scorer trained on weak labels."""
    return quality_model.quality(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


@_query("op9_quality_rules", oracles.OP9)
def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule measures and the weakly supervised verdict of every document."""
    out = quality_rules.quality_verdicts(table(spark, sf_dir, "documents"))
    return out.select(F.col("id").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                      "base_failed", "kept")


@_query("op10_url_filter")
def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule or propagated verdict on every page's url."""
    out = url_filter.judge_urls(table(spark, sf_dir, "pages"))
    return out.select(F.col("id").alias("page_id"), "host", "path", "rule", "verdict", "trust", "distrust")


@_query("op11_warc", oracles.OP11)
def op11_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages as WARC records, repeated payloads as revisits, read back from the written archives."""
    out = warc.archive_pages(table(spark, sf_dir, "pages"))
    return out.withColumnRenamed("source_id", "page_id").select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@_query("op12_conversation_repair")
def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults of damaged conversations and their cheapest repair."""
    out = repair.repair(repair.damage(table(spark, sf_dir, "conversations")))
    return out.withColumnRenamed("conv", "conv_id")


@_query("op13_tokenizer_alignment")
def op13_tokenizer_alignment(spark: SparkSession, sf_dir: str, a_path: str = BYTE_BPE_PATH, b_path: str = corpus_pipeline.MODEL_PATH) -> DataFrame:
    """Byte groups and links between the tokens of two tokenizers, with corpus counts of linked ids."""
    out = align.align_corpus(table(spark, sf_dir, "documents"), pieces.read_model(a_path), pieces.read_model(b_path))
    return out.withColumnRenamed("id", "doc_id")


@_query("pipeline", corpus_pipeline.ORACLE_SQL)
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages of corpus_pipeline over all documents."""
    return corpus_pipeline.run(spark, sf_dir)
