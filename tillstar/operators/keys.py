"""Dense surrogate keys 1..n in natural-key order, read off the places of rows in sorted files."""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tillstar.session import new_path


def store_sorted(df: DataFrame, by: str, label: str) -> str:
    """Write ``df`` as Parquet files of disjoint ranges of ``by``, each sorted by it, and return their folder."""
    path = new_path(df.sparkSession, label)
    df.repartitionByRange(by).sortWithinPartitions(by).write.parquet(path)
    return path


def _in_bytes(value: object) -> object:
    """Text as Spark orders it."""
    return value.encode() if isinstance(value, str) else value


def file_starts(spark: SparkSession, path: str, schema: StructType, by: str) -> DataFrame:
    """Per file of a sorted folder: how many rows stand in the files before it.

    Taken from one column of the files; a row a file comes to the driver, which
    lists the files anyway.
    """
    files = (
        spark.read.schema(schema)
        .parquet(path)
        .groupBy(F.col("_metadata.file_name").alias("file"))
        .agg(F.min(by).alias("first"), F.count(F.lit(1)).alias("n"))
    )
    rows = sorted(files.collect(), key=lambda row: _in_bytes(row["first"]))
    starts = accumulate((row.n for row in rows), initial=0)
    return spark.createDataFrame([(row.file, start) for row, start in zip(rows, starts)], "_file string, _start long")


def number_sorted(spark: SparkSession, path: str, schema: StructType, by: str, name: str) -> DataFrame:
    """The rows of a folder that :func:`store_sorted` has written, with their numbers in front.

    A number is the start of the row's file and the row's place in it.  Both are
    facts of files that are written once, so the numbers are the same whenever
    they are read, also after an executor is lost; nothing is sorted, shuffled
    or joined to find them but the table of starts, a row a file.
    """
    starts = file_starts(spark, path, schema, by)
    rows = spark.read.schema(schema).parquet(path)
    placed = rows.select("*", F.col("_metadata.file_name").alias("_in"), F.col("_metadata.row_index").alias("_row"))
    number = F.col("_start") + F.col("_row") + 1
    return placed.join(F.broadcast(starts), F.col("_in") == F.col("_file")).select(number.alias(name), *rows.columns)


def add_dense_key(df: DataFrame, by: str, name: str) -> DataFrame:
    """Number the rows of ``df`` by ``by``, unique and not NULL, as 1..n in its order; the number comes first.

    Rows are shuffled once, by ranges of ``by``, and stored sorted in the shared
    folder; the wide rows are neither joined to their numbers nor gathered in
    one task.
    """
    path = store_sorted(df, by, name)
    return number_sorted(df.sparkSession, path, df.schema, by, name)


def number_keys(keys: DataFrame, by: str, name: str) -> DataFrame:
    """(``by``, number) only."""
    return add_dense_key(keys.select(by), by, name).select(by, name)
