"""The corpus pipeline: five stages, each one operator applied to all that the
stage before kept.  Stages are written as Parquet and read again in between."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from stratum.llm.classify import taken
from stratum.llm.common import documents, ship, written
from stratum.llm.lines import dedup_lines
from stratum.llm.mixing import take
from stratum.llm.packing import pack_documents
from stratum.llm.simhash import keep_one


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that importance resampling takes; the rejected ones go."""
    ship(spark)
    return taken(docs, spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet"))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without later copies of repeated line runs; n_chars follows the text."""
    ship(spark)
    out = dedup_lines(docs)
    return out.selectExpr(*[f"CAST(length(text) AS BIGINT) AS {c}" if c == "n_chars" else f"`{c}`" for c in docs.columns])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component: shingles of three words, at most three bits apart."""
    ship(spark)
    return keep_one(docs, shingle=3, distance=3)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as often as the mix takes them."""
    ship(spark)
    return take(docs, weights=(5, 2, 1), cap=3.0)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents, placed in sequences of at most 4096 tokens."""
    ship(spark)
    return pack_documents(docs, tokenizer="word_bpe_49k.json", end_id=2, capacity=4096)


STAGES = [("quality", quality), ("lines", lines), ("near_duplicates", near_duplicates), ("mixing", mixing), ("packing", packing)]

# Hashing, fingerprints and tokens have no SQL; tests hold each stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; returns the packed pieces."""
    docs = documents(spark, sf_dir)
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = written(docs, f"pipeline-{name}")
    return docs
