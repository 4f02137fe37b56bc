"""The training-data pipeline: stages over the documents, each written and read again.

Every stage takes (spark, docs, sf_dir) and works on all documents that the one
before kept; all but the last return the columns of ``documents``.  Rows alike
in all columns that a stage looks at share its decision, of near duplicates one
row stays.  NULL and empty texts fail the quality rules.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstar.llm import decontaminate, neardup, packing, quality, substrings
from tillstar.llm.common import read_table, without_rejected
from tillstar.session import write_shared


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and are no outliers of their language and source."""
    key = F.xxhash64("doc_id", "text", "lang", "source")
    rows = docs.withColumn("__key", key)
    return without_rejected(
        docs, key, lambda: quality.judge(rows, doc_id="__key").select(F.col("doc_id").alias("key"), "kept")
    )


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, that with the smallest id."""
    named = F.xxhash64("doc_id", "text_hash").alias("key")
    return without_rejected(
        docs,
        F.xxhash64("doc_id", F.xxhash64("text")),
        lambda: neardup.group_documents(docs).select(named, "kept"),
        unique=True,
    )


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without passages that stood in an earlier document; ``n_chars`` is counted anew."""
    cut = substrings.remove_repeats(docs)
    return cut.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth lies in passages of the benchmark."""
    key, benchmark = F.xxhash64("doc_id", "text"), read_table(spark, sf_dir, "benchmark")
    rows = docs.withColumn("__key", key)
    kept = (~F.col("contaminated")).alias("kept")
    return without_rejected(
        docs,
        key,
        lambda: decontaminate.contamination(rows, benchmark, doc_id="__key").select(F.col("doc_id").alias("key"), kept),
    )


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of 2048 tokens."""
    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality rules", quality_rules),
    ("near duplicates", near_duplicates),
    ("substring dedup", substring_dedup),
    ("decontamination", decontamination),
    ("packing", pack),
]

# Bayesian pruning, the outliers' estimate and packing are not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces that the last stage makes of the ``documents`` table."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = write_shared(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
