"""Corpus preparation: quality rules, near copies, benchmark leaks, secrets, token ids.

Each stage takes (spark, docs, sf_dir) and returns a table that is written and read again for the next one. All stages but
the last return the columns of ``documents``; the last returns them without the text's place taken by its token ids.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from eventlode.llm.jaccard import keep_one_of_each
from eventlode.llm.leaks import drop_leaks
from eventlode.llm.pieces import add_pieces
from eventlode.llm.quality import keep_quality
from eventlode.llm.secrets import redact_secrets
from eventlode.session import materialize


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that a rule rejects go."""
    return keep_quality(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by a similarity of 0.8 on five-word shingles the one with the smallest id stays."""
    return keep_one_of_each(docs, size=5, percent=80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return drop_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets in texts give way to their kind in brackets."""
    return redact_secrets(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts as token ids, with their number and whether they decode to the text."""
    return add_pieces(docs).drop("text")


STAGES = [
    ("quality_rules", quality_rules),
    ("near_copies", near_copies),
    ("decontamination", decontamination),
    ("secrets", secrets),
    ("token_ids", token_ids),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)


# Components, latent spaces and merges are beyond SQL; tests/llm/test_pipeline.py holds the stages against plain versions.
ORACLE_SQL = None
