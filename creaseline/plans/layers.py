"""Layer tables of the driver's data, stored once per session and read by the queries that only summarise them.

A stored table is known by the session, the folder and what the folder holds (sizes and change times), so
changed input is never answered from an old table.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from creaseline.operators import conform, flatten, partials, register, season_tables
from creaseline.plans import adapter
from creaseline.sources import documents, tables
from creaseline.sources.workspace import fresh_path, settled

_STORED: dict[tuple, DataFrame] = {}


def _contents(spark: SparkSession, folder: str) -> tuple:
    """Name, size and change time of what lies in a folder."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    listed = path.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(path)
    return tuple(sorted((f.getPath().getName(), f.getLen(), f.getModificationTime()) for f in listed))


def _key(spark: SparkSession, folder: str, name: str) -> tuple:
    return (spark.sparkContext.applicationId, folder, _contents(spark, folder), name)


def stored(spark: SparkSession, folder: str, name: str, store: Callable[[], DataFrame]) -> DataFrame:
    """The table of that name, built and stored when it is first asked for."""
    key = _key(spark, folder, name)
    if key not in _STORED:
        _STORED[key] = store()
    return _STORED[key]


def over_sums(spark: SparkSession, folder: str) -> DataFrame:
    """The only table here that is built from the balls. It lies in buckets by match, so sums by match of it need no shuffle."""
    build = lambda *a: partials.over_sums(adapter.balls(*a, stored_lines(*a)))
    return bucketed(spark, folder, "over_sums", build, dealt=True)


def lines(spark: SparkSession, folder: str) -> DataFrame:
    """The lines in buckets by match, for a query that makes balls of them several times: they are dealt once."""
    return bucketed(spark, folder, "lines", adapter.dealt_lines, dealt=True)


def stored_lines(spark: SparkSession, folder: str) -> DataFrame | None:
    """The lines in buckets where a query has stored them, else None: for a single use, storing costs more than it saves."""
    return _STORED.get(_key(spark, folder, _buckets(spark, folder, "lines")))


def named_people(spark: SparkSession, folder: str) -> DataFrame:
    return adapter.people(spark, folder).withColumnRenamed("identifier", "player_id")


def batters(spark: SparkSession, folder: str) -> DataFrame:
    build = lambda: partials.batter_season(over_sums(spark, folder), named_people(spark, folder))
    return stored(spark, folder, "batters", lambda: settled(build(), "batters"))


def bowlers(spark: SparkSession, folder: str) -> DataFrame:
    build = lambda: partials.bowler_season(over_sums(spark, folder), named_people(spark, folder))
    return stored(spark, folder, "bowlers", lambda: settled(build(), "bowlers"))


def phases(spark: SparkSession, folder: str) -> DataFrame:
    build = lambda: partials.team_phase_season(over_sums(spark, folder), adapter.teams(spark, folder))
    return stored(spark, folder, "phases", lambda: settled(build(), "phases"))


def silver_matches(spark: SparkSession, folder: str) -> DataFrame:
    dealt = lambda: adapter.bronze_matches(spark, folder, dealt=True)
    build = lambda: conform.silver_matches(dealt(), order=partials.order_and_scores(over_sums(spark, folder)))
    return stored(spark, folder, "silver matches", lambda: settled(build(), "silver-matches"))


def summaries(spark: SparkSession, folder: str) -> DataFrame:
    """Match summary; in this view a team's id is its name."""
    ids = {target: F.col(name) for name, target in register.MATCH_TEAM_ROLES.items()}
    build = lambda: season_tables.match_summary(silver_matches(spark, folder).withColumns(ids))
    return stored(spark, folder, "summaries", lambda: settled(build(), "summaries"))


def team_names(spark: SparkSession, folder: str) -> DataFrame:
    build = lambda: register.team_names(silver_matches(spark, folder), adapter.noisy_balls(spark, folder, stored_lines(spark, folder)))
    return stored(spark, folder, "team names", lambda: settled(build(), "team-names"))


def teams(spark: SparkSession, folder: str) -> DataFrame:
    build = lambda: register.dim_team(team_names(spark, folder), adapter.NATION_OVERRIDES)
    return stored(spark, folder, "teams", lambda: settled(build(), "teams"))


# ------------------------------------------------------ from raw files to gold


def chain_documents(spark: SparkSession, folder: str) -> DataFrame:
    """A document per order, as files of JSON lines."""

    def store():
        path = fresh_path(spark, "raw")
        adapter.order_documents(spark, folder).select("info", "innings").write.json(path, compression="gzip")
        return documents.read_documents(spark, path, "*.json.gz", multiline=False)

    return stored(spark, folder, "chain documents", store)


def chain_teams(spark: SparkSession, folder: str) -> DataFrame:
    """The teams of the documents, from their own match and ball rows."""
    docs = chain_documents(spark, folder)
    balls = flatten.ball_rows(docs)
    names = lambda: register.team_names(conform.silver_matches(flatten.match_rows(docs), balls), balls)
    return stored(spark, folder, "chain teams", lambda: settled(register.dim_team(names(), adapter.NATION_OVERRIDES), "chain-teams"))


# What the sums per over and the resolution of names read of a silver ball.
SUMMED_COLUMNS = (
    "season", "match_id", "inning_no", "over_no", "batting_team", "bowling_team", "striker", "non_striker", "bowler",
    "runs_batter", "runs_extras", "runs_total", "extra_byes", "extra_legbyes", "extra_wides", "extra_noballs",
    "wicket_fell", "wicket_player_out", "wicket_kind",
)


def chain_sums(spark: SparkSession, folder: str) -> DataFrame:
    """Raw documents to bronze and silver balls, players and teams resolved by name, summed per over.

    Only what the sums need is stored, and only what a ball adds to them goes through the resolution. Teams
    come first: their combinations are few, and found without the players. The sums lie in buckets by match.
    """

    def build(spark, folder):
        number = adapter.parts(spark, folder)
        balls = conform.silver_deliveries(flatten.ball_rows(chain_documents(spark, folder)))
        balls = settled(balls.select(*SUMMED_COLUMNS), "chain-silver")
        people = adapter.people(spark, folder)
        short = people.select("identifier", F.concat(F.lit("S"), "identifier").alias("name"))  # as the documents name bowlers
        aliases = adapter.people_aliases(spark, folder).union(short)
        players = register.one_id_per_key(register.register_keys(people, aliases))
        keys = register.team_alias_keys(chain_teams(spark, folder)).withColumnRenamed("team_id", "id")
        named = ("season", "match_id", "inning_no", "over_no", *register.BALL_TEAM_ROLES, *register.BALL_PLAYER_ROLES)
        rows = partials.ball_sums(balls, *named)
        rows = register.resolve_roles(rows, keys, register.BALL_TEAM_ROLES, settle=settled)
        rows = register.resolve_roles(rows, players, register.BALL_PLAYER_ROLES, settle=settled, deal=number)
        return partials.summed(rows.select(*partials.OVER_KEYS, *partials.SUMS).repartition(number, "match_id"))

    return bucketed(spark, folder, "chain_sums", build, dealt=True)


def _buckets(spark: SparkSession, folder: str, name: str) -> str:
    return f"{name} in {adapter.parts(spark, folder)} buckets"


def weekly_documents(spark: SparkSession, folder: str) -> DataFrame:
    """A document per week, nested from stored lines where it is used, in the parts the lines were dealt in.

    Stored documents would be read back by a few tasks, each with many of them to sort by their folder when they are written to files.
    """
    return adapter.period_documents(spark, folder, 7, week_lines(spark, folder))


def weekly_texts(
    spark: SparkSession, folder: str, where: str = "true", change: Callable[[DataFrame], DataFrame] | None = None
) -> DataFrame:
    """The texts of the weekly documents in pieces, made where they are used of the same lines: a week's document grows with the table."""
    return adapter.period_texts(spark, folder, 7, week_lines(spark, folder), where, change)


def week_lines(spark: SparkSession, folder: str) -> DataFrame:
    return bucketed(spark, folder, "week_lines", lambda *a: adapter.period_lines(*a, 7), dealt=True, key="k")


def bucketed(
    spark: SparkSession, folder: str, name: str, build: Callable[[SparkSession, str], DataFrame], dealt: bool = False, key: str = "match_id"
) -> DataFrame:
    """A table stored in buckets by match, or by another key. Their number grows with the lines and is one for all tables of a folder, so that they join bucket by bucket.

    A session that has more shuffle partitions than before gets tables in as many buckets.
    """

    def store():
        number = adapter.parts(spark, folder)
        return tables.write_bucketed(build(spark, folder), f"{name}_{uuid.uuid4().hex}", fresh_path(spark, name), key, number, dealt)

    return stored(spark, folder, _buckets(spark, folder, name), store)
