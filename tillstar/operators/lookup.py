"""Left lookups of dimension keys that hold for large dimensions and hot keys."""

from __future__ import annotations

import math
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillstar.operators.sizes import BROADCAST_BYTES, measure

TRACKED = 10_000  # keys that a sketch holds, or so many per partition:
TRACKED_PER_PARTITION = 8
MOST_TRACKED = 1_000_000
LEAST_ROWS = 50  # of a hot key, however small an average partition is


def narrowed(dimension: DataFrame, match: str, take: Mapping[str, str]) -> DataFrame:
    """The columns a lookup needs: ``_match`` and what it takes."""
    return dimension.select(
        F.col(match).alias("_match"), *(F.col(c).alias(name) for c, name in take.items())
    )


def heavy_hitters(rows: DataFrame, keys: Mapping[str, Column], partitions: int) -> dict[str, dict[int, list]]:
    """Per name, the keys that hold more rows than an average partition, by the parts they need.

    A key with up to twice that many rows needs two parts, up to four times
    four, and so on; together that is fewer than twice ``partitions`` parts.

    All columns are read in one pass into frequent-item sketches, which tasks
    build and merge.  A sketch holds at least ``TRACKED_PER_PARTITION`` keys a
    partition (up to a million), so a count is off by less than a third of an
    average partition, and a key with a third more rows than that is never
    missed (beyond 125,000 partitions the bound grows in proportion).  The outcome decides how
    rows are spread, never which are kept.
    """
    tracked = min(MOST_TRACKED, max(TRACKED, TRACKED_PER_PARTITION * partitions))
    named = {name: f"_k{i}" for i, name in enumerate(keys)}
    narrow = rows.select(*(key.alias(named[name]) for name, key in keys.items()))
    most = min(partitions + 1, tracked)  # more keys than partitions cannot all be above the average; NULL is one
    sketches = [F.expr(f"approx_top_k({column}, {most}, {tracked})").alias(column) for column in named.values()]
    told = narrow.agg(F.count(F.lit(1)).alias("_rows"), *sketches).first()
    average = told["_rows"] / partitions
    found: dict[str, dict[int, list]] = {}
    for name, column in named.items():
        hot = found[name] = {}
        for item in told[column]:
            if item["item"] is not None and item["count"] > max(average, LEAST_ROWS):
                hot.setdefault(2 ** math.ceil(math.log2(item["count"] / average)), []).append(item["item"])
    return found


def hot_keys(rows: DataFrame, key: Column, partitions: int) -> dict[int, list]:
    """:func:`heavy_hitters` of one column."""
    return heavy_hitters(rows, {"key": key}, partitions)["key"]


def with_parts(rows: DataFrame, key: Column, hot: Mapping[int, list]) -> DataFrame:
    """Add ``_parts``: in how many parts the rows of a key are spread.

    The hot keys are a broadcast table, whose size ``hot_keys`` bounds.
    """
    if not hot:
        return rows.withColumn("_parts", F.lit(1))
    kind = rows.select(key.alias("k")).schema["k"].dataType
    schema = T.StructType([T.StructField("_hot", kind), T.StructField("_hot_parts", T.IntegerType())])
    listed = [(k, n) for n, keys in hot.items() for k in keys]
    table = rows.sparkSession.createDataFrame(listed, schema)
    return (
        rows.join(F.broadcast(table), key == F.col("_hot"), "left")
        .withColumn("_parts", F.coalesce("_hot_parts", F.lit(1)))
        .drop("_hot", "_hot_parts")
    )


def look_up(
    rows: DataFrame,
    dimension: DataFrame,
    on: Column,
    match: str,
    take: Mapping[str, str],
    spread_by: str,
    broadcast_bytes: int = BROADCAST_BYTES,
    size: int | None = None,
    hot: Mapping[int, list] | None = None,
) -> DataFrame:
    """Left join ``dimension`` on ``on`` = ``match`` and add the columns ``take``.

    ``take`` maps dimension columns to names in the result.  ``match`` must be
    unique, so no row multiplies; a row without a match gets NULL.

    The dimension is first narrowed and measured (``size``, if the caller has
    done that).  Up to ``broadcast_bytes`` it is broadcast.  Beyond that both
    sides are shuffled, and rows whose key is hot or NULL are spread by a salt
    from ``spread_by``, a unique column; the dimension row of a hot key is
    repeated once per part.  ``hot`` is what :func:`heavy_hitters` says of ``on``,
    if the caller has asked for several lookups at once.
    """
    narrow = narrowed(dimension, match, take)
    kept = [F.col(c) for c in [*rows.columns, *take.values()]]
    same_key = on == F.col("_match")

    if size is None:
        (size,) = measure([narrow])
    if size <= broadcast_bytes:
        return rows.join(F.broadcast(narrow), same_key, "left").select(*kept)

    partitions = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if hot is None:
        hot = hot_keys(rows, on, partitions)
    parts = F.when(on.isNull(), partitions).otherwise(F.col("_parts"))
    left = with_parts(rows, on, hot).withColumn("_salt", F.pmod(F.xxhash64(spread_by), parts))
    salts = F.sequence(F.lit(0), F.col("_parts") - 1)
    right = with_parts(narrow, F.col("_match"), hot).withColumn("_of_salt", F.explode(salts))
    left, right = left.drop("_parts"), right.drop("_parts").hint("merge")
    same = same_key & (F.col("_salt") == F.col("_of_salt"))
    return left.join(right, same, "left").select(*kept)
