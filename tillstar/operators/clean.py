"""Row cleaning: one row per key, required references."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillstar.operators.sizes import BROADCAST_BYTES, SMALL_BYTES, estimated_bytes, stored_with_size


def require(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Keep rows in which none of ``columns`` is NULL."""
    present = [F.col(c).isNotNull() for c in columns]
    return df.filter(reduce(and_, present)) if present else df


def first_per_key(df: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The first row of every key by ``order``, NULLs last.

    Spark limits each group to its first row before the shuffle
    (WindowGroupLimit), so a key with very many copies sends one row per map task.
    """
    first_first = [F.col(c).asc_nulls_last() for c in order] or [F.lit(0)]
    window = Window.partitionBy(*key).orderBy(*first_first)
    return (
        df.withColumn("_place", F.row_number().over(window))
        .filter(F.col("_place") == 1)
        .drop("_place")
    )


def dedupe(
    df: DataFrame,
    key: Sequence[str],
    order: Sequence[str] | None = None,
    small_bytes: int = SMALL_BYTES,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Keep one row per key: the first by ``order``, NULLs last.

    ``order`` defaults to all other columns, which leaves only identical rows
    tied, so the survivor never depends on partitioning.

    In a table of more than ``small_bytes`` (an estimate) keys that repeat are
    found first, by a count over the key columns alone, and stored.  Rows of
    other keys pass as they are, neither sorted nor shuffled; only those of
    repeated keys are ordered.  Repeated keys of more than ``broadcast_bytes``
    are too many to be told to every task; then, and in small tables, where
    another pass costs more than it saves, all rows are ordered.
    """
    key = list(key)
    order = [c for c in df.columns if c not in key] if order is None else list(order)
    if estimated_bytes(df) <= small_bytes:
        return first_per_key(df, key, order)
    names = [f"_key_{i}" for i in range(len(key))]
    counts = df.groupBy(*(F.col(c).alias(name) for c, name in zip(key, names))).agg(F.count(F.lit(1)).alias("_n"))
    repeated, size = stored_with_size(counts.filter(F.col("_n") > 1).select(*names), "repeated-keys")
    if size == 0:
        return df
    if size > broadcast_bytes:
        return first_per_key(df, key, order)
    same = reduce(and_, (F.col(c).eqNullSafe(F.col(name)) for c, name in zip(key, names)))
    once = df.join(F.broadcast(repeated), same, "left_anti")
    several = df.join(F.broadcast(repeated), same, "left_semi")
    return once.unionByName(first_per_key(several, key, order))
