"""Season and match tables of the gold layer.

Each is one scan of the balls. Sums are taken per innings, over or pairing first,
so what is shuffled afterwards is small however often one player or team occurs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from creaseline.functions.metrics import (
    balls_per_wicket,
    batting_rate,
    charged_runs,
    credited_wicket,
    economy_rate,
    faced,
    legal,
    overs,
    phase,
    ratio,
    tally,
)
from creaseline.operators.rollups import INNINGS_SCORES, appearances, innings_played, innings_scores, is_maiden, over_totals


def with_name(df: DataFrame, dim: DataFrame | None, key: str, dim_key: str, dim_name: str, name: str) -> DataFrame:
    """Add a display name from a dimension; a typed null without one."""
    if dim is None:
        return df.withColumn(name, F.lit(None).cast("string"))
    names = dim.select(F.col(dim_key).alias(key), F.col(dim_name).alias(name))
    return df.join(names, key, "left")


def totals(*columns: str) -> list[Column]:
    return [F.sum(c).alias(c) for c in columns]


def batter_season(balls: DataFrame, dim_player: DataFrame | None = None) -> DataFrame:
    """Batting record per season and striker."""
    record = (
        innings_played(balls)
        .groupBy("season", "striker_id")
        .agg(*appearances(), *totals("runs", "balls_faced", "fours", "sixes", "outs"))
    )
    return batter_columns(record, dim_player)


def batter_columns(record: DataFrame, dim_player: DataFrame | None) -> DataFrame:
    """Name and rates of a batting record."""
    return with_name(record, dim_player, "striker_id", "player_id", "name", "player_name").select(
        "season", "striker_id", "player_name", "matches_played", "innings_batted",
        "runs", "balls_faced", "fours", "sixes", "outs",
        ratio(F.col("runs"), F.col("outs")).alias("average"),
        batting_rate(F.col("runs"), F.col("balls_faced")).alias("strike_rate"),
    )


def bowler_season(balls: DataFrame, dim_player: DataFrame | None = None) -> DataFrame:
    """Bowling record per season and bowler."""
    record = (
        over_totals(balls)
        .groupBy("season", "bowler_id")
        .agg(
            F.sum("balls").alias("balls_bowled"),
            tally(is_maiden()).alias("maidens"),
            F.sum("conceded").alias("runs_conceded"),
            F.sum("wkts").alias("wkts"),
        )
    )
    return bowler_columns(record, dim_player)


def bowler_columns(record: DataFrame, dim_player: DataFrame | None) -> DataFrame:
    """Name and rates of a bowling record."""
    bowled, conceded, wkts = (F.col(c) for c in ("balls_bowled", "runs_conceded", "wkts"))
    return with_name(record, dim_player, "bowler_id", "player_id", "name", "player_name").select(
        "season", "bowler_id", "player_name", "balls_bowled",
        overs(bowled).alias("overs_bowled"),
        "maidens", "runs_conceded", "wkts",
        economy_rate(conceded, bowled).alias("economy"),
        ratio(conceded, wkts).alias("average"),
        balls_per_wicket(bowled, wkts).alias("strike_rate"),
    )


BATTING_TOTALS = ("runs_scored", "balls_faced", "fours", "sixes", "wickets_lost")
BOWLING_TOTALS = ("runs_conceded", "balls_bowled", "wkts_taken")


def team_phase_season(balls: DataFrame, dim_team: DataFrame | None = None) -> DataFrame:
    """Batting and bowling record per season, team and phase.

    The balls are summed once per pairing of teams; each pairing then counts for
    its batting side and for its bowling side. A side that never batted (or
    bowled) in a phase has zero totals and null overs and rate.
    """
    pairings = balls.groupBy(
        "season", "batting_team_id", "bowling_team_id", phase(F.col("over_no")).alias("phase")
    ).agg(
        F.sum("runs_total").alias("runs_scored"),
        tally(faced()).alias("balls_faced"),
        tally(F.col("runs_batter") == 4).alias("fours"),
        tally(F.col("runs_batter") == 6).alias("sixes"),
        tally(F.col("wicket_fell")).alias("wickets_lost"),
        F.sum(charged_runs()).alias("runs_conceded"),
        tally(legal()).alias("balls_bowled"),
        tally(credited_wicket()).alias("wkts_taken"),
    )
    return phase_columns(pairings, dim_team)


def phase_columns(pairings: DataFrame, dim_team: DataFrame | None) -> DataFrame:
    """The record of each team from the sums of each pairing, with name and rates."""

    def role(team: str, kept: tuple[str, ...]) -> Column:
        unset = F.lit(None).cast("bigint")
        measures = [
            (F.col(c) if c in kept else unset).alias(c) for c in BATTING_TOTALS + BOWLING_TOTALS
        ]
        return F.struct(F.col(team).alias("team_id"), *measures)

    both = F.array(role("batting_team_id", BATTING_TOTALS), role("bowling_team_id", BOWLING_TOTALS))
    record = (
        pairings.select("season", "phase", F.explode(both).alias("side"))
        .select("season", "phase", "side.*")
        .where("team_id is not null")
        .groupBy("season", "team_id", "phase")
        .agg(*totals(*BATTING_TOTALS, *BOWLING_TOTALS))
        .withColumns({"overs_faced": overs(F.col("balls_faced")), "overs_bowled": overs(F.col("balls_bowled"))})
        .na.fill(0, [*BATTING_TOTALS, *BOWLING_TOTALS])
    )
    return with_name(record, dim_team, "team_id", "team_id", "name_canonical", "team_name").select(
        "season", "team_id", "team_name", "phase", "runs_scored", "balls_faced", "overs_faced",
        economy_rate(F.col("runs_scored"), F.col("balls_faced")).alias("run_rate"),
        "fours", "sixes", "wickets_lost", "runs_conceded", "balls_bowled", "overs_bowled",
        economy_rate(F.col("runs_conceded"), F.col("balls_bowled")).alias("economy"),
        "wkts_taken",
    )


def match_summary(matches: DataFrame, balls: DataFrame | None = None) -> DataFrame:
    """Match row with the totals of both innings and whether the chase succeeded.

    The totals come from the balls, or are already in ``matches`` (from
    :func:`rollups.order_and_scores`), where the balls are then not read again.
    """
    kept = (
        "match_id", "season", "team1", "team1_id", "team2", "team2_id", "winner", "winner_id", "result_std", "match_start_dt",
        "venue", "city", "first_batting_team", "first_batting_team_id", "second_batting_team", "second_batting_team_id",
    )
    chased = F.coalesce(F.col("winner_id") == F.col("second_batting_team_id"), F.lit(False))
    if balls is not None:
        matches = matches.select(*kept).join(innings_scores(balls), "match_id", "left")
    return matches.select(*kept, *INNINGS_SCORES).withColumn("chase_success", chased)
