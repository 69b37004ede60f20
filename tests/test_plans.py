"""The shape of the main plans when nothing is small enough to broadcast."""

import re

import pytest
from pyspark.sql import functions as F

from creaseline.operators import conform, register, rollups, season_tables
from creaseline.sources import tables
from creaseline.sources.workspace import settled

COLUMNS = (
    "season string, match_id string, inning_no int, over_no int, ball_in_over int, batting_team string, bowling_team string, "
    "batting_team_id string, bowling_team_id string, striker string, striker_id string, bowler_id string, "
    "runs_batter int, runs_extras int, runs_total int, extra_byes int, extra_legbyes int, extra_wides int, "
    "extra_noballs int, wicket_fell boolean, wicket_player_out string, wicket_kind string, note string"
)


@pytest.fixture(scope="module")
def balls(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("balls"))
    spark.createDataFrame([], COLUMNS).write.mode("overwrite").parquet(path)
    return spark.read.schema(COLUMNS).parquet(path)


@pytest.fixture(autouse=True)
def nothing_is_small(spark):
    settings = {"spark.sql.autoBroadcastJoinThreshold": -1, "spark.sql.maxMetadataStringLength": 5000}
    for name, value in settings.items():
        spark.conf.set(name, value)
    yield
    for name in settings:
        spark.conf.unset(name)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def shuffles(df):
    return len(re.findall(r"Exchange hashpartitioning", plan(df)))


def test_one_scan_and_few_shuffles(balls):
    for build, most in (
        (season_tables.batter_season, 3),
        (season_tables.bowler_season, 2),
        (season_tables.team_phase_season, 2),
        (rollups.innings_scores, 1),
        (rollups.innings_rollup, 1),
        (rollups.innings_side_by_side, 2),
        (conform.batting_order, 2),
    ):
        df = build(balls)
        assert plan(df).count("FileScan") == 1, build.__name__
        assert shuffles(df) <= most, build.__name__
        assert "partial_" in plan(df)


def test_balls_are_hashed_not_sorted(balls):
    for build in (season_tables.batter_season, season_tables.bowler_season, rollups.innings_scores, rollups.innings_rollup):
        assert "SortAggregate" not in plan(build(balls))


def test_columns_and_filters_reach_the_scan(balls):
    text = plan(season_tables.bowler_season(balls.where("season = '2010'")))
    scan = re.search(r"PushedFilters: \[(.*?)\].*ReadSchema: struct<(.*)>", text)
    assert "EqualTo(season,2010)" in scan[1] and "IsNotNull(bowler_id)" in scan[1]
    assert "note" not in scan[2] and "striker" not in scan[2]


def test_resolution_folds_distinct_names_only_and_without_python(spark, balls):
    keys = spark.createDataFrame([], "id string, key string")
    stored = []

    def settle(table):
        stored.append(table)
        return settled(table)

    register.resolve_roles(balls.select("match_id", "striker"), keys, {"striker": "striker_id"}, settle=settle)
    names = next(plan(table) for table in stored if "key" in table.columns)
    final, partial = re.findall(r"HashAggregate\(keys=\[text#\d+\].*output=\[(.*?)\]", names)
    assert "key#" in final and "key#" not in partial
    text = plan(register.resolve_roles(balls.select("match_id", "striker"), keys, {"striker": "striker_id"}))
    assert "Python" not in text
    assert "translate(" not in text[: text.index("FileScan")]  # the facts themselves are not folded


def test_hot_season_is_not_left_to_one_task(spark, tmp_path):
    """All rows in one season: the writer still makes several files."""
    rows = spark.range(400000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("text"), F.lit("2010").alias("season"))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "2MB")
    try:
        path = tables.write_table(rows, f"{tmp_path}/t", partition_by=["season"])
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    back = spark.read.parquet(path)
    assert back.count() == 400000
    assert back.select("_metadata.file_name").distinct().count() > 3


def test_hot_player_and_match_keep_all_rows(spark):
    """Two thirds of all balls belong to one match and one player."""
    n = 90000
    hot = F.col("id") % 3 != 0
    rows = spark.range(n).select(
        F.lit("2010").alias("season"),
        F.when(hot, "m").otherwise(F.col("id").cast("string")).alias("match_id"),
        F.lit(1).alias("inning_no"),
        F.when(hot, "p").otherwise((F.col("id") % 100).cast("string")).alias("striker_id"),
        F.lit("s").alias("striker"),
        F.lit(1).alias("runs_batter"),
        F.lit(0).alias("extra_wides"),
        F.lit(False).alias("wicket_fell"),
        F.lit(None).cast("string").alias("wicket_player_out"),
    )
    record = season_tables.batter_season(rows)
    p = record.where("striker_id = 'p'").first()
    assert (p.runs, p.balls_faced, p.matches_played, p.innings_batted) == (n * 2 // 3, n * 2 // 3, 1, 1)
    assert record.agg(F.sum("runs")).first()[0] == n
