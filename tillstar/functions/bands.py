"""Bands: label a value by the first cut that holds."""

from __future__ import annotations

import operator
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

COMPARE = {
    "<": operator.lt,
    "<=": operator.le,
    ">=": operator.ge,
    "=": operator.eq,
    "has": lambda text, part: text.contains(part),
    "in": lambda value, options: value.isin(*options),
}


def band(value: Column, cuts: Sequence[tuple], otherwise: str) -> Column:
    """CASE over ``cuts`` (comparison, limit, label), in order.

    A NULL value passes no cut, so it takes ``otherwise``, as does a value
    beyond the last cut.
    """
    chain = reduce(
        lambda case, cut: case.when(COMPARE[cut[0]](value, cut[1]), cut[2]),
        cuts,
        F,
    )
    return chain.otherwise(otherwise)
