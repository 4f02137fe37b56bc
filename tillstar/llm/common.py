"""What several operators of this package share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstar.session import new_path, scratch

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
BROADCAST_BYTES = 8 * 1024 * 1024
ROW = "__row"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lower_ascii(text: Column) -> Column:
    """A to Z in lower case; every other character as it is."""
    return F.translate(text, UPPER, UPPER.lower())


def numbered(df: DataFrame, *columns: str) -> DataFrame:
    """The named columns and a number per row, unique within one evaluation.

    Rows with equal or NULL ids stay apart by it.  Evaluate it once: write the
    result (or what follows from it) to the shared folder before using it twice.
    """
    return df.select(*columns).withColumn(ROW, F.monotonically_increasing_id())


def small(df: DataFrame, row_bytes: int, most: int = BROADCAST_BYTES) -> bool:
    """Whether a table, at so many bytes a row, may be sent to every executor."""
    return df.count() * row_bytes <= most


def settled(spark: SparkSession, make: Callable[[], DataFrame], label: str) -> DataFrame:
    """What ``make`` returns, stored; the tables that it stores on its way are removed."""
    path = new_path(spark, label)
    with scratch(spark):
        made = make()
        made.write.parquet(path)
    return spark.read.schema(made.schema).parquet(path)


def without_rejected(
    docs: DataFrame, key: Column, decide: Callable[[], DataFrame], unique: bool = False
) -> DataFrame:
    """The rows of ``docs`` that the decisions (key, kept) keep, all columns as they are.

    ``key`` is a 64-bit fingerprint of a row.  Rows with the same one stay if one
    of them is kept; with ``unique`` only one of them stays.  The rejected
    fingerprints are broadcast if their measured size allows, so that texts need
    no shuffle; otherwise both sides are shuffled by fingerprint.
    """
    told = settled(
        docs.sparkSession,
        lambda: decide().groupBy("key").agg(F.max("kept").alias("kept"), F.count("*").alias("n")),
        "decisions",
    )
    rejected = told.filter("NOT kept").select("key")
    few = small(rejected, 64)
    rows = docs.withColumn("__key", key).join(
        F.broadcast(rejected) if few else rejected, F.col("__key") == F.col("key"), "left_anti"
    )
    if unique and told.filter("kept AND n > 1").limit(1).count():
        rows = rows.dropDuplicates(["__key"])
    return rows.drop("__key")
