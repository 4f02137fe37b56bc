"""How often a column's values occur, without gathering a group on one task."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillstar.operators.sizes import BROADCAST_BYTES, SMALL_BYTES, estimated_bytes, stored_with_size

# A value's rows are counted and joined in this many parts per shuffle partition,
# so one value that fills a third of the table is spread as well as other data.
PARTS_PER_PARTITION = 4


def _as_text(df: DataFrame, column: str) -> Column:
    """Text that tells a column's values apart as they compare: 0.0 and -0.0 are one."""
    value = F.col(column)
    if df.schema[column].dataType.simpleString() in ("float", "double"):
        value = F.when(value == 0, F.lit(0.0)).otherwise(value)
    return value.cast("string")


def _values(df: DataFrame, columns: Sequence[str], *also: Column) -> DataFrame:
    """(``_of``, ``_value``) per row and column: all columns in one pass, a single one without multiplying rows."""
    if len(columns) == 1:
        return df.select(*also, F.lit(0).alias("_of"), _as_text(df, columns[0]).alias("_value"))
    pairs = [F.struct(F.lit(i).alias("_of"), _as_text(df, c).alias("_value")) for i, c in enumerate(columns)]
    return df.select(*also, F.inline(F.array(*pairs)))


def repeated_values(df: DataFrame, columns: Sequence[str]) -> tuple[DataFrame, int]:
    """(``_of``, ``_value``, ``_n``) of the values that more than one row has, NULL among them, stored; and its bytes.

    Counted with map-side counts, so a value that fills a third of the table is
    one row per task before the one exchange that all columns share.
    """
    counts = _values(df, columns).groupBy("_of", "_value").agg(F.count(F.lit(1)).alias("_n"))
    return stored_with_size(counts.filter(F.col("_n") > 1), "repeated-values")


def _with_counts(df: DataFrame, columns: Sequence[str], repeated: DataFrame) -> DataFrame:
    """Add ``_n0``, ``_n1``, ...: how often the value of each column occurs, NULL for once."""
    for i, column in enumerate(columns):
        of = repeated.filter(F.col("_of") == i).select(F.col("_value").alias(f"_v{i}"), F.col("_n").alias(f"_n{i}"))
        df = df.join(F.broadcast(of), _as_text(df, column).eqNullSafe(F.col(f"_v{i}")), "left").drop(f"_v{i}")
    return df


def flag_unique(
    df: DataFrame,
    key: str,
    flags: Mapping[str, str],
    small_bytes: int = SMALL_BYTES,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Add a boolean per entry of ``flags`` (flag -> column): the value occurs once.

    NULLs count as one group, so a lone NULL is unique.  In a table of more than
    ``small_bytes`` (an estimate), values that repeat are counted first, all
    columns in one pass, and stored: one row a value, however many rows have it.
    Up to ``broadcast_bytes`` they are broadcast, and the rows stay where they
    are.  Beyond, and in small tables, ``key``, unique and not NULL, serves: a
    value that occurs once is named by its row's key, the flags of a key are the
    bits of one number, and rows meet it in one join by key.
    """
    if not flags:
        return df
    columns = list(flags.values())
    if estimated_bytes(df) > small_bytes:
        repeated, size = repeated_values(df, columns)
        if size <= broadcast_bytes:
            counted = _with_counts(df, columns, repeated)
            named = {flag: F.col(f"_n{i}").isNull() for i, flag in enumerate(flags)}
            return counted.withColumns(named).drop(*(f"_n{i}" for i in range(len(flags))))
    singles = (
        _values(df, columns, F.col(key).alias("_key"))
        .groupBy("_of", "_value")
        .agg(F.count(F.lit(1)).alias("_n"), F.min("_key").alias("_only"))
        .filter(F.col("_n") == 1)
    )
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("_of"))
    if len(columns) == 1:
        marked = singles.select("_only", bit.alias("_bits"))
    else:
        marked = singles.groupBy("_only").agg(F.bit_or(bit).alias("_bits"))
    rows = df.join(marked, F.col(key) == F.col("_only"), "left")
    held = F.coalesce("_bits", F.lit(0))
    named = {flag: held.bitwiseAND(1 << i) != 0 for i, flag in enumerate(flags)}
    return rows.withColumns(named).drop("_only", "_bits")


def add_group_size(
    df: DataFrame,
    key: str,
    column: str,
    name: str,
    small_bytes: int = SMALL_BYTES,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Add the number of rows that share the row's value (NULLs count together).

    In a table of more than ``small_bytes`` (an estimate) repeated values are
    counted and stored first, and broadcast up to ``broadcast_bytes``.  Beyond,
    and in small tables, counts run in two steps, per (value, part) and then over
    the parts, and rows join on both.  Parts come from ``key``, so no task sees a
    whole hot value; in the second step a value has at most one row per part.
    """
    if estimated_bytes(df) > small_bytes:
        repeated, size = repeated_values(df, [column])
        if size <= broadcast_bytes:
            counted = _with_counts(df, [column], repeated)
            return counted.withColumn(name, F.coalesce("_n0", F.lit(1)).cast("bigint")).drop("_n0")
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    part = F.pmod(F.xxhash64(key), F.lit(PARTS_PER_PARTITION * partitions))
    df = df.withColumn("_part", part)
    sizes = (
        df.groupBy(F.col(column).alias("_value"), F.col("_part").alias("_in_part"))
        .agg(F.count(F.lit(1)).alias("_n"))
        .select(
            "_value",
            "_in_part",
            F.sum("_n").over(Window.partitionBy("_value")).alias(name),
        )
    )
    same = df[column].eqNullSafe(sizes["_value"]) & (df["_part"] == sizes["_in_part"])
    return df.join(sizes, same, "left").drop("_value", "_part", "_in_part")
