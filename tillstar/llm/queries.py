"""The registered queries of this package: every operator over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstar.llm import (
    decontaminate,
    divergence,
    exactdup,
    grammar,
    licenses,
    manifest,
    neardup,
    packing,
    quality,
    substrings,
    toxicity,
    urls,
    warc,
)
from tillstar.llm.common import ROW, lower_ascii, read_table

# The rules of the URL query.
URL_RULES = [
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
]


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, benchmark = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark")
    return decontaminate.contamination(docs, benchmark)


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_documents(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(read_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op4_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.remove_repeats(read_table(spark, sf_dir, "documents"))


def op5_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, action string")
    return urls.judge_urls(read_table(spark, sf_dir, "pages"), rules)


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(read_table(spark, sf_dir, "pages"), url="url")


def op7_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.group_documents(read_table(spark, sf_dir, "documents"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(read_table(spark, sf_dir, "documents")).drop(ROW, "distance")


def op9_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grammar.round_trip(read_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op10_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(read_table(spark, sf_dir, "documents"))


def op11_exactdup(spark: SparkSession, sf_dir: str) -> DataFrame:
    told = exactdup.group_equal(read_table(spark, sf_dir, "documents"), all_digests=True)
    digest = F.lower(F.hex("digest")).alias("text_sha256")
    return told.select("doc_id", "keep_id", "group_size", "kept", digest)


def op12_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    def tampered(fields):
        fifth = F.crc32(fields["doc_id"].cast("string")) % 5 == 0
        return fifth, {"text": lower_ascii(fields["text"])}

    proved = manifest.prove_documents(read_table(spark, sf_dir, "documents"), changed=tampered)
    back = manifest.folded(F.coalesce("changed_leaf", "leaf"), F.col("places"), F.col("siblings"))
    return proved.select(
        F.col("order").alias("doc_id"),
        "leaf",
        "subroot",
        "root",
        F.sha2(F.array_join("siblings", ""), 256).alias("proof_sha256"),
        back.alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


def op13_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(read_table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    made = [
        op1_decontaminate, op2_toxicity, op3_packing, op4_substrings, op5_urls, op6_warc, op7_neardup, op8_quality,
        op9_tokens, op10_licenses, op11_exactdup, op12_manifest, op13_divergence,
    ]
    return {query.__name__: query for query in made}
