"""A table's rules, and the steps that apply them.

Rules are data: what makes a row, how its text is written, which flags judge
it, which columns are derived.  Flags only annotate; no step drops a row for a
failed flag.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame

from tillstar.functions import AsOf, standardise
from tillstar.operators.clean import dedupe, require
from tillstar.operators.unique import add_group_size, flag_unique

Columns = Mapping[str, Column]


@dataclass(frozen=True)
class TableRules:
    name: str
    key: str
    flags: Callable[[AsOf], Columns]
    derived: Callable[[AsOf], Sequence[Columns]]  # one mapping per dependency level
    required: Sequence[str] = ()  # references that must not be NULL
    text: Mapping[str, Sequence[str]] = field(default_factory=dict)  # casing -> columns
    unique: Mapping[str, str] = field(default_factory=dict)  # flag -> column
    group_sizes: Mapping[str, str] = field(default_factory=dict)  # count -> column
    measured: Callable[[AsOf], Columns] = lambda as_of: {}  # columns the flags read
    added: Sequence[str] = ()  # flags and derived columns in order, where it is not theirs above

    def flag_names(self) -> list[str]:
        return [*self.unique, *self.flags(AsOf())]


def clean(df: DataFrame, rules: TableRules) -> DataFrame:
    """One row per key, required references present, text standardised.

    Rows without a key go first: they would collapse to one row that is then
    dropped, and this way they are not shuffled.  References are tested after
    the dedupe, on the surviving row.
    """
    rows = dedupe(require(df, [rules.key]), [rules.key])
    return standardise(require(rows, rules.required), rules.text)


def validate(df: DataFrame, rules: TableRules, as_of: AsOf = AsOf()) -> DataFrame:
    """Add the quality flags, TRUE, FALSE or NULL (unknown)."""
    for name, column in rules.group_sizes.items():
        df = add_group_size(df, rules.key, column, name)
    df = flag_unique(df, rules.key, rules.unique)
    measured = rules.measured(as_of)
    if measured:
        df = df.withColumns(measured)
    return df.withColumns(rules.flags(as_of))


def derive(df: DataFrame, rules: TableRules, as_of: AsOf = AsOf()) -> DataFrame:
    """Add the derived columns, one projection per dependency level."""
    for level in rules.derived(as_of):
        df = df.withColumns(level)
    return df


def transform(df: DataFrame, rules: TableRules, as_of: AsOf = AsOf()) -> DataFrame:
    """The wide table: source columns cleaned in place, flags, derived columns."""
    wide = derive(validate(clean(df, rules), rules, as_of), rules, as_of)
    return wide.select(*df.columns, *rules.added) if rules.added else wide
