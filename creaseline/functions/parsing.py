"""Lenient conversions from raw text. Bad input gives null, never an error."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, functions as F

# Accepted spellings and date patterns.
TOSS_DECISIONS = {"bat": "bat", "field": "field", "bowl": "field"}
RESULT_KINDS = {
    "runs": "runs",
    "wickets": "wickets",
    "tie": "tie",
    "no result": "no_result",
    "match tied": "tie",
}
DATE_PATTERNS = ("yyyy-MM-dd", "yyyy/MM/dd", "dd-MMM-yyyy")


def enum_value(col: Column, spellings: Mapping[str, str]) -> Column:
    """Trimmed lower-case value looked up in ``spellings``; unknown gives null.

    With no spellings the cleaned value itself is returned.
    """
    cleaned = F.lower(F.trim(col))
    return lookup(cleaned, spellings) if spellings else cleaned


def lookup(key: Column, table: Mapping[str, str]) -> Column:
    """Literal table lookup; null when the key is absent."""
    if not table:
        return F.lit(None).cast("string")
    pairs = [F.lit(text) for item in table.items() for text in item]
    return F.try_element_at(F.create_map(*pairs), key)


def first_date(col: Column, patterns: Sequence[str] = DATE_PATTERNS) -> Column:
    """Date by the first pattern that fits."""
    return F.coalesce(*(F.try_to_timestamp(col, F.lit(p)).cast("date") for p in patterns))


def to_flag(col: Column) -> Column:
    return col.try_cast("boolean")


def to_number(col: Column) -> Column:
    return col.try_cast("double")


def any_of(conditions: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions)
