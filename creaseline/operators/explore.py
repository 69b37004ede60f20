"""Filters, rankings and summaries behind the exploration pages.

A filter is a set of conditions. Each names columns and values, and holds where one of the
columns, read as text, has one of the values; null never does. A condition without values,
with the value ``All``, or on columns that a table lacks, demands nothing.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from creaseline.functions.parsing import any_of, to_number

ALL = "All"

# The columns that each kind of choice is compared with, by the table it is made on.
MATCH_CHOICES = {"season": ["season"], "team": ["team1", "team2", "winner"], "venue": ["venue"], "result": ["result_std"]}
PLAYER_CHOICES = {"season": ["season"], "player": ["player_name"]}
PHASE_CHOICES = {"season": ["season"], "team": ["team_name"], "phase": ["phase"]}


def restricted(df: DataFrame, choices: Mapping[str, Sequence[str]], **picked: Sequence[str]) -> DataFrame:
    """Rows that meet every condition: ``picked`` has the values, ``choices`` their columns.

    A choice that the table does not offer is ignored.
    """
    conditions = []
    for choice, values in picked.items():
        columns = [F.col(c).cast("string") for c in choices.get(choice, ()) if c in df.columns]
        if columns and values and ALL not in values:
            conditions.append(any_of([c.isin(*values) for c in columns]))
    return df.where(reduce(Column.__and__, conditions)) if conditions else df


def reaching(df: DataFrame, **least: float) -> DataFrame:
    """Rows whose columns reach the given values; columns the table lacks are ignored."""
    return df.where(reduce(Column.__and__, (F.col(c) >= x for c, x in least.items() if c in df.columns), F.lit(True)))


def ranked(column: str, ascending: bool = False) -> Column:
    """Sort order with nulls last in either direction."""
    return F.asc_nulls_last(column) if ascending else F.desc_nulls_last(column)


def preview(df: DataFrame, n: int, *order: str | Column) -> DataFrame:
    """The first ``n`` rows in a stated order."""
    return df.orderBy(*order).limit(n)


def top_n(df: DataFrame, metric: str, n: int = 10, ascending: bool = False, tie_break: Sequence[str] = ()) -> DataFrame:
    """The first ``n`` rows by a metric; no rows when the table lacks it."""
    return preview(df, n, ranked(metric, ascending), *tie_break) if metric in df.columns else df.limit(0)


def named_table(tables: Mapping[str, Callable[[], DataFrame]], name: str) -> DataFrame | None:
    """A table by name, built only when asked for; None for an unknown name."""
    build = tables.get(name)
    return build() if build else None


def match_explorer(matches: DataFrame, **picked: Sequence[str]) -> DataFrame:
    """Matches that were chosen, latest first."""
    return restricted(matches, MATCH_CHOICES, **picked).orderBy(ranked("match_start_dt"), "match_id")


def season_total(record: DataFrame, measure: str) -> DataFrame:
    """A measure summed per season; rows without season are left out."""
    return (
        record.where(F.col("season").isNotNull())
        .groupBy("season")
        .agg(F.coalesce(F.sum(measure), F.lit(0).cast("bigint")).alias(measure))
        .orderBy("season")
    )


def chase_rate(matches: DataFrame) -> DataFrame:
    """Share of successful chases per season in percent."""
    return (
        matches.where(F.col("season").isNotNull())
        .groupBy("season")
        .agg((F.avg(F.col("chase_success").cast("int")) * 100).alias("chase_success_rate"))
        .orderBy("season")
    )


def headline_figures(matches: DataFrame, batting: DataFrame, bowling: DataFrame) -> DataFrame:
    """Matches, seasons, teams, runs and wickets as one row each.

    The matches are read once: they are counted per season and pair of teams first.
    """
    per_pair = matches.groupBy("season", "team1", "team2").agg(F.count(F.lit(1)).alias("n"))
    entries = F.inline(
        F.array(
            F.struct(F.lit("Matches").alias("metric"), F.lit(None).cast("string").alias("name"), F.col("n").alias("n")),
            *(
                F.struct(F.lit(metric).alias("metric"), F.col(c).cast("string").alias("name"), F.lit(1).cast("bigint").alias("n"))
                for metric, c in (("Seasons", "season"), ("Teams", "team1"), ("Teams", "team2"))
            ),
        )
    )
    names = per_pair.select(entries).where("metric = 'Matches' OR name IS NOT NULL").groupBy("metric", "name").agg(F.sum("n").alias("n"))
    held = names.agg(
        F.sum(F.when(F.col("metric") == "Matches", F.col("n"))).alias("Matches"),
        F.count_if(F.col("metric") == "Seasons").alias("Seasons"),
        F.count_if(F.col("metric") == "Teams").alias("Teams"),
    )

    def lines(df: DataFrame, *metrics: str) -> DataFrame:
        pairs = (F.struct(F.lit(m).alias("metric"), F.coalesce(F.col(m), F.lit(0)).cast("bigint").alias("value")) for m in metrics)
        return df.select(F.inline(F.array(*pairs)))

    parts = [
        lines(held, "Matches", "Seasons", "Teams"),
        lines(batting.agg(F.sum("runs").alias("Runs")), "Runs"),
        lines(bowling.agg(F.sum("wkts").alias("Wickets")), "Wickets"),
    ]
    return reduce(DataFrame.unionByName, parts)


def value_counts(df: DataFrame, column: str, name: str = "matches") -> DataFrame:
    """Rows per value, most frequent first; null is no value."""
    return (
        df.where(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias(name))
        .orderBy(F.desc(name), column)
    )


def chase_outcomes(matches: DataFrame) -> DataFrame:
    """Matches per labelled chase outcome, an unknown outcome included."""
    label = F.when(F.col("chase_success"), "Successful").when(~F.col("chase_success"), "Not Successful")
    return (
        matches.groupBy(F.coalesce(label, F.lit("Unknown")).alias("chase_success"))
        .agg(F.count(F.lit(1)).alias("matches"))
        .orderBy(F.desc("matches"), "chase_success")
    )


def top_values_and_rest(df: DataFrame, column: str, n: int = 20) -> DataFrame:
    """The ``n`` most frequent values and one ``Other`` row for all the rest.

    The rest is the grand total less the top values, so no window over all
    values is needed.
    """
    counts = df.groupBy(F.col(column).cast("string").alias("value")).agg(F.count(F.lit(1)).alias("count"))
    top = counts.orderBy(F.desc("count"), F.asc_nulls_last("value")).limit(n)
    tallied = [F.sum("count").alias("rows"), F.count(F.lit(1)).alias("values")]
    less = top.agg(*tallied).select((-F.col("rows")).alias("rows"), (-F.col("values")).alias("values"))
    rest = (
        counts.agg(*tallied)
        .union(less)
        .agg(F.sum("rows").alias("count"), F.sum("values").alias("values"))
        .where("values > 0")
        .select(F.lit("Other").alias("value"), "count")
    )
    return top.union(rest)


def group_means(record: DataFrame, keys: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """Mean of each measure per group; groups with a missing key are left out."""
    return (
        record.na.drop(subset=list(keys))
        .groupBy(*keys)
        .agg(*(F.avg(m).alias(m) for m in measures))
        .orderBy(*keys)
    )


def player_comparison(batting: DataFrame, bowling: DataFrame, players: Sequence[str]) -> DataFrame:
    """Career totals of the chosen players side by side; nothing done counts as zero."""

    def summed(record: DataFrame, measures: Mapping[str, str]) -> DataFrame:
        rows = record.where(F.col("player_name").isin(*players))
        return rows.groupBy("player_name").agg(*(F.sum(c).alias(name) for c, name in measures.items()))

    bat = summed(batting, {c: c for c in ("runs", "balls_faced", "fours", "sixes")})
    bowl = summed(bowling, {"wkts": "wickets", "balls_bowled": "balls_bowled", "runs_conceded": "runs_conceded"})
    return bat.join(bowl, "player_name", "full").na.fill(0)


def option_lists(sources: Sequence[tuple[DataFrame, Mapping[str, Sequence[str]]]]) -> DataFrame:
    """Distinct values per named list, each list over columns of one or more tables.

    Every table is read once, whatever number of lists it feeds.
    """
    found = []
    for df, lists in sources:
        entries = [
            F.struct(F.lit(name).alias("list"), F.col(c).cast("string").alias("option"))
            for name, columns in lists.items()
            for c in columns
            if c in df.columns
        ]
        if entries:
            found.append(df.select(F.inline(F.array(*entries))).where("option is not null").distinct())
    if not found:
        raise ValueError("no table has any of the option columns")
    return reduce(DataFrame.union, found).distinct().orderBy("list", "option")


def distinct_options(sources: Sequence[tuple[DataFrame, Sequence[str]]]) -> DataFrame:
    """Sorted distinct values over columns of several tables."""
    return option_lists([(df, {"": columns}) for df, columns in sources]).select("option")


def scatter_points(df: DataFrame, x: str, y: str, size: str | None = None) -> DataFrame:
    """Rows with numeric x and y; sizes that are missing or negative become 0."""
    points = df.withColumns({c: to_number(F.col(c)) for c in (x, y)}).na.drop(subset=[x, y])
    if size and size in points.columns:
        points = points.withColumn(
            size, F.greatest(F.coalesce(to_number(F.col(size)), F.lit(0.0)), F.lit(0.0))
        )
    return points


