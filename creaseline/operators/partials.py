"""Sums that merge: one table from which every gold table and summary follows.

A row holds, for one over, the sums of the balls between one batter and one bowler of two
sides. All measures of the gold tables are sums over such rows, so tables of several deliveries
of balls are merged by putting their rows together, and the balls are read once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from creaseline.functions.metrics import charged_runs, credited_wicket, faced, legal, ones, phase, tally
from creaseline.operators.conform import in_innings
from creaseline.operators.rollups import appearances, is_maiden
from creaseline.operators.season_tables import (
    BATTING_TOTALS,
    BOWLING_TOTALS,
    batter_columns,
    bowler_columns,
    phase_columns,
    totals,
)

OVER_KEYS = (
    "season", "match_id", "inning_no", "over_no", "striker_id", "bowler_id", "batting_team", "batting_team_id", "bowling_team_id",
)
SUMS = ("runs_total", "scored", "balls_faced", "balls_legal", "fours", "sixes", "outs", "wickets", "conceded", "credited")


def ball_sums(balls: DataFrame, *kept: str) -> DataFrame:
    """The ``kept`` columns of each ball and what it adds to the sums of its over: less to shuffle than the ball."""
    scored = F.col("runs_batter")
    added = (
        F.col("runs_total"),
        scored.cast("int"),
        ones(faced()),
        ones(legal()),
        ones(scored == 4),
        ones(scored == 6),
        ones(F.col("wicket_fell") & (F.col("wicket_player_out") == F.col("striker"))),
        ones(F.col("wicket_fell")),
        charged_runs(),
        ones(credited_wicket()),
    )
    return balls.select(*kept, *(value.alias(name) for name, value in zip(SUMS, added)))


def summed(rows: DataFrame) -> DataFrame:
    """One row per over, batter, bowler and sides, from rows of :func:`ball_sums`."""
    return merged(rows, *OVER_KEYS, **{name: name for name in SUMS})


def over_sums(balls: DataFrame) -> DataFrame:
    """One row per over, batter, bowler and sides, with the sums of its balls."""
    return summed(ball_sums(balls, *OVER_KEYS))


def merged(sums: DataFrame, *keys: str, **measures: str) -> DataFrame:
    """Sums of the named columns per key, under new names."""
    return sums.groupBy(*keys).agg(*(F.sum(column).alias(name) for name, column in measures.items()))


def batter_season(sums: DataFrame, dim_player: DataFrame | None = None) -> DataFrame:
    """As :func:`season_tables.batter_season`, from over sums."""
    innings = merged(
        sums.where("striker_id is not null"), "season", "striker_id", "match_id", "inning_no",
        runs="scored", balls_faced="balls_faced", fours="fours", sixes="sixes", outs="outs",
    )
    record = innings.groupBy("season", "striker_id").agg(*appearances(), *totals("runs", "balls_faced", "fours", "sixes", "outs"))
    return batter_columns(record, dim_player)


def bowler_season(sums: DataFrame, dim_player: DataFrame | None = None) -> DataFrame:
    """As :func:`season_tables.bowler_season`, from over sums."""
    overs = merged(
        sums.where("bowler_id is not null"), "season", "bowler_id", "match_id", "inning_no", "over_no",
        conceded="conceded", balls="balls_legal", wkts="credited",
    )
    record = overs.groupBy("season", "bowler_id").agg(
        F.sum("balls").alias("balls_bowled"), tally(is_maiden()).alias("maidens"), F.sum("conceded").alias("runs_conceded"), F.sum("wkts").alias("wkts")
    )
    return bowler_columns(record, dim_player)


def team_phase_season(sums: DataFrame, dim_team: DataFrame | None = None) -> DataFrame:
    """As :func:`season_tables.team_phase_season`, from over sums."""
    columns = ("runs_total", "balls_faced", "fours", "sixes", "wickets", "conceded", "balls_legal", "credited")
    named = dict(zip((*BATTING_TOTALS, *BOWLING_TOTALS), columns))
    pairings = merged(
        sums.withColumn("phase", phase(F.col("over_no"))), "season", "batting_team_id", "bowling_team_id", "phase", **named
    )
    return phase_columns(pairings, dim_team)


def order_and_scores(sums: DataFrame) -> DataFrame:
    """As :func:`rollups.order_and_scores`, from over sums."""
    sides = merged(sums, "match_id", "inning_no", "batting_team", runs="runs_total", wkts="wickets", balls="balls_legal")
    team = F.col("batting_team")
    return sides.groupBy("match_id").agg(
        F.min(in_innings(1, team)).alias("first_batting_team"),
        F.min(in_innings(2, team)).alias("second_batting_team"),
        *(F.sum(in_innings(n, F.col(c))).alias(f"inning{n}_{c}") for n in (1, 2) for c in ("runs", "wkts", "balls")),
    )


# ------------------------------------------------ distinct counts and medians


def numbered(values: DataFrame, column: str, known: DataFrame | None = None) -> DataFrame:
    """``column`` and ``number``: the distinct values that ``known`` lacks, numbered after its own.

    Numbers are unique, and dense within a task's values. The result must be stored before
    it is used: computed again, numbers may differ.
    """
    new = values.select(column).where(F.col(column).isNotNull()).distinct()
    own = F.monotonically_increasing_id()
    if known is None:
        return new.select(column, own.alias("number"))
    last = known.agg(F.max("number")).first()[0]
    return new.join(known, column, "left_anti").select(column, (own + (0 if last is None else last + 1)).alias("number"))


def bitmaps(rows: DataFrame, *keys: str, number: str = "number") -> DataFrame:
    """Which numbers occur per key, as bitmaps of 32,768 neighbouring numbers.

    A bitmap has 4 KB however few numbers it holds: worth it where a key has many of a
    bucket's numbers, or where distinct counts of many deliveries are merged often.
    """
    place = F.bitmap_bit_position(F.col(number))
    return rows.groupBy(*keys, F.bitmap_bucket_number(F.col(number)).alias("bucket")).agg(F.bitmap_construct_agg(place).alias("seen"))


def distinct_counts(maps: DataFrame, *keys: str, name: str) -> DataFrame:
    """Exact distinct counts over the bitmaps of any number of deliveries."""
    either = maps.groupBy(*keys, "bucket").agg(F.bitmap_or_agg("seen").alias("seen"))
    return either.groupBy(*keys).agg(F.sum(F.bitmap_count("seen")).alias(name))


SKETCH_SIZE = 400
SKETCH_ERROR = 0.02  # of the rank, with a wide margin at that size


def sketches(rows: DataFrame, column: str, *keys: str, size: int = SKETCH_SIZE) -> DataFrame:
    """Quantile sketches of a whole-number column per key: some kilobytes each, which merge."""
    return rows.groupBy(*keys).agg(F.kll_sketch_agg_bigint(F.col(column).cast("bigint"), size).alias("sketch"))


def merged_quantile(held: DataFrame, share: float) -> DataFrame:
    """Rows sketched and the quantile over all of them, its rank within SKETCH_ERROR of the share."""
    whole = held.agg(F.kll_merge_agg_bigint("sketch").alias("sketch"))
    return whole.select(
        F.kll_sketch_get_n_bigint("sketch").alias("rows"), F.kll_sketch_get_quantile_bigint("sketch", F.lit(share)).alias("value")
    )
