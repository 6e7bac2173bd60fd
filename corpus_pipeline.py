"""Corpus pipeline over ``documents``: quality rules, line dedup, near dedup, decontamination, SentencePiece.

Each stage takes the rows its predecessor kept and returns the columns of
documents, the last one with its pieces; each result is written as Parquet and
read again as the next stage's input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from medalcast.llm import decontaminate, line_dedup, near_dedup, pieces, quality_rules
from medalcast.llm.stage import Scratch, table

MODEL_PATH = "/opt/tokenizers/piece_bpe_32k.model"


#: Rows of an Arrow batch: texts are long, and both ends of the pipe to Python hold a batch.
BATCH_ROWS = 2_000


def _settings(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    _settings(spark)
    return quality_rules.keep_good(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that an earlier document or line has, within one edit, go; documents left without a word go."""
    _settings(spark)
    return line_dedup.dedup_lines(docs, size_col="n_chars" if "n_chars" in docs.columns else None)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class stays."""
    _settings(spark)
    return near_dedup.keep_one(docs, num=80, band_rows=7)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share benchmark passages with a twentieth of their words or more go."""
    _settings(spark)
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str, model_path: str = MODEL_PATH) -> DataFrame:
    """Adds the piece ids of each text, their number, and whether they decode to it."""
    _settings(spark)
    def fresh(name):
        while name in docs.columns:
            name += "_"
        return name
    ids, same = fresh("pieces"), fresh("lossless")
    out = pieces.encode(docs, pieces.read_model(model_path), out_col=ids, check_col=same)
    return out.withColumn(fresh("n_pieces"), F.size(F.col(ids)))


STAGES = [("quality_rules", rules), ("line_dedup", lines), ("near_dedup", near), ("decontamination", benchmark), ("sentencepiece", tokens)]
ORACLE_SQL = None   # registers, agenda merges and weak supervision aren't SQL; tested against brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    scratch = Scratch(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    try:
        for name, stage in STAGES:
            docs = scratch.write(stage(spark, docs, sf_dir), name)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    return docs
