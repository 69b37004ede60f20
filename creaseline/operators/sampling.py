"""Small samples that keep related rows together."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def first_keys(df: DataFrame, key: str, n: int) -> DataFrame:
    """The ``n`` smallest distinct values of a key."""
    return df.where(F.col(key).isNotNull()).select(key).distinct().orderBy(key).limit(n)


def rows_of(df: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """All rows of the given keys; the keys never pass through the driver."""
    return df.join(keys, key, "left_semi")


def earliest(df: DataFrame, column: str) -> DataFrame:
    """All rows holding the smallest value of a column."""
    first = df.agg(F.min(column).alias(column))
    return df.join(F.broadcast(first), column, "left_semi")  # one row by construction


def head_in_order(df: DataFrame, n: int, *order: str | Column) -> DataFrame:
    return df.orderBy(*order).limit(n)
