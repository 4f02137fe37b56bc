"""Parquet output."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

# Where the wide tables go, and how one of them is partitioned.
PROCESSED = ["customers", "products", "stores", "suppliers", "employees", "promotions"]
EVENTS = ["orders", "order_items", "payments", "shipments", "inventory", "returns"]
PARTITIONED_BY = {"orders": ["order_year", "order_month"]}

PROCESSED_DIR = "data/processed"
DIMENSIONS_DIR = "warehouse/dimensions"
FACTS_DIR = "warehouse/facts"


def write_parquet(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = (),
    observe: Sequence[Column] = (),
) -> dict[str, int]:
    """Overwrite ``path`` with ``df`` and return what was written.

    The result holds ``rows`` and any further aggregates in ``observe``, all
    taken while the rows pass to the files, so no second job counts them.

    A partitioned write first rebalances on the partition columns: a value's
    rows land in few files, and a value that holds much of the table is split
    over several tasks.
    """
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    written = Observation()
    df = df.observe(written, F.count(F.lit(1)).alias("rows"), *observe)
    df.write.mode("overwrite").parquet(path, partitionBy=list(partition_by) or None)
    return written.get


def processed_path(root: str, name: str) -> str:
    return f"{root}/{PROCESSED_DIR}/{name}"


def dimension_path(root: str, name: str) -> str:
    return f"{root}/{DIMENSIONS_DIR}/{name}"


def fact_path(root: str, name: str) -> str:
    return f"{root}/{FACTS_DIR}/{name}"


def wide_path(root: str, name: str) -> str:
    """Master tables go to the processed area, event tables to the facts."""
    return processed_path(root, name) if name in PROCESSED else fact_path(root, name)


def load_processed(
    df: DataFrame,
    root: str,
    name: str,
    partition_by: Sequence[str] = (),
    observe: Sequence[Column] = (),
) -> dict[str, int]:
    return write_parquet(df, processed_path(root, name), partition_by, observe)


def load_dimension(df: DataFrame, root: str, name: str) -> dict[str, int]:
    return write_parquet(df, dimension_path(root, name))


def load_fact(
    df: DataFrame,
    root: str,
    name: str,
    partition_by: Sequence[str] = (),
    observe: Sequence[Column] = (),
) -> dict[str, int]:
    return write_parquet(df, fact_path(root, name), partition_by, observe)


def load_wide(
    df: DataFrame, root: str, name: str, observe: Sequence[Column] = ()
) -> dict[str, int]:
    """Write one wide table to its place; ``orders`` by year and month."""
    load = load_processed if name in PROCESSED else load_fact
    return load(df, root, name, PARTITIONED_BY.get(name, ()), observe)


def load_all(wide: Mapping[str, DataFrame], root: str) -> dict[str, dict[str, int]]:
    """Write the twelve wide tables."""
    return {name: load_wide(wide[name], root, name) for name in [*PROCESSED, *EVENTS]}


def load_warehouse(
    dimensions: Mapping[str, DataFrame], facts: Mapping[str, DataFrame], root: str
) -> dict[str, dict[str, int]]:
    """Write every dimension and fact."""
    written = {name: load_dimension(df, root, name) for name, df in dimensions.items()}
    written |= {name: load_fact(df, root, name) for name, df in facts.items()}
    return written
