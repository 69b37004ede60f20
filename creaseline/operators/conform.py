"""Bronze rows to silver rows: fixed types, standard values, batting order."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from creaseline.functions.parsing import DATE_PATTERNS, RESULT_KINDS, TOSS_DECISIONS, enum_value, first_date
from creaseline.sources.schemas import SILVER_DELIVERIES, SILVER_MATCHES


def in_innings(number: int, value: Column) -> Column:
    """The value on rows of one innings, null elsewhere."""
    return F.when(F.col("inning_no") == number, value)


def silver_deliveries(balls: DataFrame) -> DataFrame:
    """Ball rows in the silver layout; rows that are no ball are left behind."""
    return balls.where(F.col("delivery_id").isNotNull()).select(
        *(F.col(field.name).cast(field.dataType).alias(field.name) for field in SILVER_DELIVERIES)
    )


def batting_order(balls: DataFrame) -> DataFrame:
    """Who batted first and second, one row per match.

    Reduced to distinct sides first: hashing does that, whereas the smallest of
    many texts would be found by sorting every ball.
    """
    team = F.col("batting_team")
    sides = balls.select("match_id", "inning_no", "batting_team").distinct()
    return sides.groupBy("match_id").agg(
        F.min(in_innings(1, team)).alias("first_batting_team"),
        F.min(in_innings(2, team)).alias("second_batting_team"),
    )


def silver_matches(
    matches: DataFrame,
    balls: DataFrame | None = None,
    toss_decisions: Mapping[str, str] = TOSS_DECISIONS,
    result_kinds: Mapping[str, str] = RESULT_KINDS,
    date_patterns: Sequence[str] = DATE_PATTERNS,
    order: DataFrame | None = None,
) -> DataFrame:
    """Match rows with standard toss decision, result and dates.

    The batting order comes from the balls where they are given, or from ``order``, a table
    with it per match, and is null otherwise. Further columns of ``order`` are kept.
    """
    standard = matches.withColumns(
        {
            "toss_decision_std": enum_value(F.col("toss_decision"), toss_decisions),
            "result_std": enum_value(F.col("result"), result_kinds),
            "match_start_dt": first_date(F.col("match_start_date"), date_patterns),
            "match_end_dt": first_date(F.col("match_end_date"), date_patterns),
        }
    )
    if balls is not None:
        order = batting_order(balls)
    if order is None:
        unknown = F.lit(None).cast("string")
        standard = standard.withColumns({"first_batting_team": unknown, "second_batting_team": unknown})
    else:
        standard = standard.join(order, "match_id", "left")
    layout = SILVER_MATCHES.fieldNames()
    return standard.select(*layout, *(c for c in (order.columns if order is not None else ()) if c not in layout))
