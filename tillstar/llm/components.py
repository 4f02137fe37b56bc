"""Connected components of a distributed list of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstar.session import write_shared

MOST_ROUNDS = 60


def connected(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Rows (node, root) for every node of a link; root is the smallest node of its component.

    Alternating large-star and small-star rounds, each written to the shared
    folder.  A hub with very many links is a minimum combined on the map side
    and a join that adaptive execution splits, never one gathered list.  Links
    with a NULL end or to the node itself say nothing; no links give no rows.
    """
    ends = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter(
        F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b))
    )
    ends = write_shared(ends.distinct(), "links")
    for _ in range(MOST_ROUNDS):
        both = ends.unionByName(ends.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        after = least.select("u", F.col("m").alias("v")).unionByName(small).distinct()
        after = write_shared(after, "links")
        same = _state(ends) == _state(after)
        ends = after
        if same:
            roots = ends.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
            return ends.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
    raise RuntimeError(f"components did not settle in {MOST_ROUNDS} rounds")


def _state(ends: DataFrame) -> tuple:
    """Count and order-free checksum of a set of links."""
    return tuple(ends.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.bit_xor(F.xxhash64("v", "u", "u"))).first())
