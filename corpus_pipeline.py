"""The corpus pipeline: quality rules, near-dedup, secret scans, mixing, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; its rows are written as
Parquet in the cluster's shared folder and read again as the next stage's docs. All but the
last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from obsframe.llm import mixing, neardup, packing, quality, secrets
from obsframe.llm.common import table, written


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that fail a rule of the full policy."""
    return quality.kept_documents(docs, "full-1")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group linked by 5-word shingles at a similarity of 0.8."""
    return neardup.deduplicated(docs, shingle=5, percent=80)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace every secret by a mark."""
    return secrets.masked(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeat, keep, cut or drop documents as the mix takes them."""
    return mixing.mixed_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of 2048 tokens."""
    return packing.pack(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("near dedup", near_dedup),
    ("secret scan", secret_scan),
    ("source mix", source_mix),
    ("packing", pack),
]

#: Near-dedup by sketches and packing by a tokenizer have no SQL; tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
