"""Quality summary: row counts and, per flag, how many passed, failed, are unknown."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tillstar.functions import AsOf
from tillstar.operators.rules import TableRules, clean, validate


def flag_counts(flags: Sequence[str]) -> list[Column]:
    """Three aggregates per flag.  A NULL flag is neither passed nor failed."""
    return [
        F.count_if(test).alias(f"{flag}.{outcome}")
        for flag in flags
        for outcome, test in (
            ("passed", F.col(flag)),
            ("failed", ~F.col(flag)),
            ("unknown", F.col(flag).isNull()),
        )
    ]


def _long(counts: DataFrame) -> DataFrame:
    return counts.unpivot([], [F.col(f"`{c}`") for c in counts.columns], "metric", "value")


def count_flags(df: DataFrame, flags: Sequence[str]) -> DataFrame:
    """All flags of a table in one pass, as rows (metric, value)."""
    return _long(df.agg(*flag_counts(flags)))


def summarise(raw: DataFrame, rules: TableRules, as_of: AsOf = AsOf()) -> DataFrame:
    """Rows (metric, value) for one table, from one aggregate over its checked rows.

    The rows of the source are observed while they pass to it, so nothing is
    read a second time for their count.  A few numbers come to the driver.
    """
    seen, n = Observation(), F.count(F.lit(1))
    checked = validate(clean(raw.observe(seen, n.alias("rows")), rules), rules, as_of)
    kept = checked.agg(n.alias("rows_cleaned"), *flag_counts(rules.flag_names())).first().asDict()
    # Where no row is left, Spark replaces the plan, and what was observed in it is lost.
    initial = seen.get["rows"] if kept["rows_cleaned"] else raw.count()
    told = {"rows_initial": initial, "rows_final": kept["rows_cleaned"], "duplicates_removed": initial - kept["rows_cleaned"]}
    return raw.sparkSession.createDataFrame(list((kept | told).items()), "metric string, value bigint")
