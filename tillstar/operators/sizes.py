"""Sizes of tables, by which a join is chosen."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillstar.session import write_shared

BROADCAST_BYTES = 64 << 20
SMALL_BYTES = 64 << 20  # of a table that one plan handles faster than a pass that looks at it first
LARGE_BYTES = 512 << 20  # of a table, as its files hold it, that has a cluster to itself
VALUE_BYTES = 16  # counted per value, besides the text it holds


def measure(tables: Sequence[DataFrame]) -> list[int]:
    """Bytes each table holds, counted over its rows, all in one job."""

    def size(place: int, df: DataFrame) -> DataFrame:
        text = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
        held = [F.coalesce(F.sum(F.octet_length(c)), F.lit(0)) for c in text]
        rows = F.count(F.lit(1)) * (VALUE_BYTES * len(df.columns))
        return df.agg(sum(held, rows).alias("bytes")).select(F.lit(place).alias("place"), "bytes")

    if not tables:
        return []
    sizes = reduce(DataFrame.union, (size(i, df) for i, df in enumerate(tables)))
    return [row.bytes for row in sorted(sizes.collect())]


def known_size(df: DataFrame, rows: int | None) -> int | None:
    """The bytes of a table of so many rows as :func:`measure` counts them, if it holds no text."""
    if rows is None or any(isinstance(f.dataType, T.StringType) for f in df.schema.fields):
        return None
    return rows * VALUE_BYTES * len(df.columns)


def fits(df: DataFrame, row_bytes: int, most: int = BROADCAST_BYTES) -> bool:
    """Whether a stored table, at so many bytes a row, may be sent to every executor."""
    return df.count() * row_bytes <= most


def estimated_bytes(df: DataFrame) -> int:
    """Catalyst's estimate of a table, from the sizes of its files; no job runs."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def stored_with_size(df: DataFrame, label: str) -> tuple[DataFrame, int]:
    """``df`` stored in the shared folder, and its bytes as :func:`measure` counts them, told by the write itself."""
    seen = Observation()
    text = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    held = [F.coalesce(F.sum(F.octet_length(c)), F.lit(0)) for c in text]
    rows = F.count(F.lit(1)) * (VALUE_BYTES * len(df.columns))
    stored = write_shared(df.observe(seen, sum(held, rows).alias("bytes")), label)
    return stored, seen.get["bytes"]
