"""Text standardisation: every listed column is trimmed, some are also cased."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CASINGS = {
    "trim": lambda text: text,
    "title": F.initcap,
    "upper": F.upper,
    "lower": F.lower,
}


def standardise(df: DataFrame, casings: Mapping[str, Sequence[str]]) -> DataFrame:
    """Replace text columns in place, in one projection.

    ``casings`` maps a casing (trim, title, upper, lower) to column names.
    """
    return df.withColumns(
        {
            column: CASINGS[casing](F.trim(F.col(column)))
            for casing, columns in casings.items()
            for column in columns
        }
    )
