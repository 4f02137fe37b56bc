"""Operators over whole tables."""

from tillstar.operators.clean import dedupe, require
from tillstar.operators.keys import add_dense_key, number_keys
from tillstar.operators.lookup import look_up
from tillstar.operators.quality import count_flags, flag_counts, summarise
from tillstar.operators.rules import TableRules, clean, derive, transform, validate
from tillstar.operators.unique import add_group_size, flag_unique

__all__ = [
    "TableRules",
    "add_dense_key",
    "add_group_size",
    "clean",
    "count_flags",
    "dedupe",
    "derive",
    "flag_counts",
    "flag_unique",
    "look_up",
    "number_keys",
    "require",
    "summarise",
    "transform",
    "validate",
]
