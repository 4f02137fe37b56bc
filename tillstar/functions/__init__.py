"""Column helpers: text standardisation, checks, bands, dates."""

from tillstar.functions.bands import band
from tillstar.functions.checks import (
    is_one_of,
    is_positive_id,
    is_present,
    matches,
    matches_whole,
    percent_of,
    rounds_to,
)
from tillstar.functions.dates import AsOf, days_between, years_between
from tillstar.functions.text import standardise

__all__ = [
    "AsOf",
    "band",
    "days_between",
    "is_one_of",
    "is_positive_id",
    "is_present",
    "matches",
    "matches_whole",
    "percent_of",
    "rounds_to",
    "standardise",
    "years_between",
]
