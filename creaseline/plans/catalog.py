"""Every registered query: a name and a function of (session, data folder)."""

from __future__ import annotations

from collections.abc import Callable
from pyspark.sql import DataFrame, SparkSession, functions as F

from creaseline.functions import keys as key_fn, metrics, parsing, text as text_fn
from creaseline.operators import (
    conform,
    explore,
    flatten,
    partials,
    quality,
    register,
    rollups,
    sampling,
    season_tables,
)
from creaseline.plans import adapter, layers
from creaseline.plans.adapter import table
from creaseline.sources import documents, ingest, lineage, pieces, schemas, tables, versions
from creaseline.sources.workspace import fresh_path, settled

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

SEASONS = ("1996", "1998")
TEAMS = ("NATION_3", "NATION_11")
PLAYERS = tuple(f"Supplier#{n:09d}" for n in (3, 7, 12, 40))
PHASES = ("PP", "DEATH")


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def joined(column: str):
    """An array column as sorted text, to compare across engines."""
    return F.array_join(F.array_sort(column), "|").alias(column)


# --------------------------------------------------------- layer tables


def player_dimension(spark: SparkSession, folder: str) -> DataFrame:
    return register.dim_player(adapter.people(spark, folder), adapter.people_aliases(spark, folder))


def batter_table(spark: SparkSession, folder: str, lines: DataFrame | None = None) -> DataFrame:
    names = adapter.people(spark, folder).withColumnRenamed("identifier", "player_id")
    return season_tables.batter_season(adapter.season_balls(spark, folder, lines), names)


def bowler_table(spark: SparkSession, folder: str, lines: DataFrame | None = None) -> DataFrame:
    names = adapter.people(spark, folder).withColumnRenamed("identifier", "player_id")
    return season_tables.bowler_season(adapter.season_balls(spark, folder, lines), names)


def phase_table(spark: SparkSession, folder: str, lines: DataFrame | None = None) -> DataFrame:
    return season_tables.team_phase_season(adapter.balls(spark, folder, lines), adapter.teams(spark, folder))


def silver_match_table(spark: SparkSession, folder: str, lines: DataFrame | None = None) -> DataFrame:
    return conform.silver_matches(adapter.bronze_matches(spark, folder), adapter.balls(spark, folder, lines))


def summary_table(spark: SparkSession, folder: str, lines: DataFrame | None = None) -> DataFrame:
    """Match summary; in this view a team's id is its name."""
    order = rollups.order_and_scores(adapter.balls(spark, folder, lines))
    matches = conform.silver_matches(adapter.bronze_matches(spark, folder), order=order)
    ids = {target: F.col(name) for name, target in register.MATCH_TEAM_ROLES.items()}
    return season_tables.match_summary(matches.withColumns(ids))


def innings_table(spark: SparkSession, folder: str) -> DataFrame:
    return rollups.innings_rollup(adapter.balls(spark, folder))


# ------------------------------------------------- scans, sources, sinks


@query
def scan_json_nested(spark, folder):
    """Documents as JSON lines, the form for many documents per file."""
    path = fresh_path(spark, "documents")
    adapter.order_documents(spark, folder).select("info", "innings").write.json(path, compression="gzip")
    return flatten.ball_rows(documents.read_documents(spark, path, "*.json.gz", multiline=False)).select(*BALL_COLUMNS)


@query
def scan_json_multiline(spark, folder):
    """One indented document per file, a file per day of orders."""
    path = fresh_path(spark, "documents")
    documents.write_document_files(adapter.period_documents(spark, folder), path)
    return flatten.ball_rows(documents.read_documents(spark, path, "*.txt.gz")).select(*BALL_COLUMNS)


@query
def scan_file_subset(spark, folder):
    path = fresh_path(spark, "documents")
    documents.write_document_files(adapter.period_documents(spark, folder), path, "k")
    return documents.read_documents(spark, path, "*.txt.gz", first=50).select(
        F.col("info.venue").alias("venue"), F.col("info.season").alias("season")
    )


@query
def raw_profile(spark, folder):
    profile = flatten.raw_profile(adapter.order_documents(spark, folder))
    return profile.select(
        "season",
        "venue",
        F.array_join("teams", "|").alias("teams"),
        F.array_join("dates", "|").alias("dates"),
        F.col("toss.decision").alias("toss_decision"),
        F.col("outcome.winner").alias("winner"),
        "n_innings",
        "inning1_team",
        "src_file_path",
    )


@query
def scan_csv_register(spark, folder):
    path = fresh_path(spark, "people")
    adapter.people(spark, folder).write.option("header", True).csv(path)
    return documents.read_register(spark, path, schemas.PEOPLE)


@query
def scan_table(spark, folder):
    orders = tables.read_table(spark, f"{folder}/orders.parquet", "parquet")
    return orders.select("o_orderkey", "o_orderstatus", "o_totalprice")


@query
def sink_partitioned_roundtrip(spark, folder):
    path = fresh_path(spark, "balls")
    rows = adapter.season_balls(spark, folder).select("season", "match_id", "inning_no", "runs_total")
    tables.write_table(rows, path, partition_by=["season"])
    back = tables.read_table(spark, path, schema=rows.schema)
    return back.groupBy("season").agg(
        F.count(F.lit(1)).alias("balls"), F.sum("runs_total").alias("runs"), F.max(F.typeof("season")).alias("type")
    )


@query
def sink_staged_overwrite(spark, folder):
    path = fresh_path(spark, "matches")
    tables.write_table(adapter.match_sides(spark, folder).select("o_orderkey", "season", "team1"), path, partition_by=["season"])
    stored = tables.read_table(spark, path, schema=schemas.fields(o_orderkey=schemas.BIG, **schemas.columns(schemas.TEXT, "team1", "season")))
    tables.replace_table(stored.withColumn("team1_key", text_fn.plain_name_key(F.col("team1"))), path, partition_by=["season"])
    layout = schemas.fields(o_orderkey=schemas.BIG, **schemas.columns(schemas.TEXT, "team1", "team1_key", "season"))
    return tables.read_table(spark, path, schema=layout)


@query
def scan_missing_as_empty(spark, folder):
    """Orders exist; a table of returns was never written and reads as empty."""
    schema = schemas.fields(o_orderkey=schemas.BIG, o_orderstatus=schemas.TEXT)

    def counted(name):
        rows = tables.read_or_empty(spark, f"{folder}/{name}.parquet", schema)
        return rows.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table"), "rows")

    return counted("orders").union(counted("returns"))


NAMED_TABLES = {
    "gold.batter_season": batter_table,
    "gold.bowler_season": bowler_table,
    "gold.team_phase_season": phase_table,
    "gold.match_summary": summary_table,
    "silver.matches": silver_match_table,
    "silver.dim_player": lambda spark, folder, lines: player_dimension(spark, folder),
    "silver.dim_team": lambda spark, folder, lines: layers.teams(spark, folder),
    "silver.deliveries_sample": lambda spark, folder, lines: explore.preview(
        adapter.season_balls(spark, folder, lines).select(*SAMPLE_COLUMNS), 5000, *SAMPLE_COLUMNS
    ),
}
SAMPLE_COLUMNS = ("match_id", "inning_no", "over_no", "ball_in_over", "striker", "bowler", "runs_total", "season")


@query
def named_table_head(spark, folder):
    named = {name: lambda build=build: build(spark, folder, None) for name, build in NAMED_TABLES.items()}
    return explore.named_table(named, "silver.deliveries_sample")


@query
def named_tables(spark, folder):
    """Rows of every table that can be asked for by name. Six of them are made of balls: the lines are dealt once for all."""
    lines = layers.lines(spark, folder)
    named = {name: lambda build=build: build(spark, folder, lines) for name, build in NAMED_TABLES.items()}
    sizes = [tables.table_size(explore.named_table(named, name)).select(F.lit(name).alias("table"), "rows", "columns") for name in named]
    return quality.combine(sizes)


@query
def sink_versions(spark, folder):
    """A table replaced twice: a reader opened before, the version read by its number, and the table as it is."""
    path = fresh_path(spark, "versioned")
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderstatus")
    tables.replace_table(orders, path)
    opened = tables.read_table(spark, path)
    tables.replace_table(opened.where("o_orderstatus <> 'O'"), path)
    tables.replace_table(tables.read_table(spark, path).where("o_orderstatus = 'F'"), path)
    second = versions.read_part(spark, path, version=versions.read_version(spark, path, 2))
    seen = {"opened before": opened, "second": second, "latest": tables.read_table(spark, path)}
    counts = [F.count(F.lit(1)).alias("rows"), F.sum("o_orderkey").alias("keys")]
    return quality.combine([df.agg(*counts).withColumn("reader", F.lit(name)) for name, df in seen.items()])


@query
def export_csv_head(spark, folder):
    rows = batter_table(spark, folder).select("season", "striker_id", "player_name", "runs", "balls_faced", "outs")
    path = tables.export_csv(rows, fresh_path(spark, "export"), 500, "season", "striker_id")
    return spark.read.schema(rows.schema).option("header", True).csv(path)


@query
def table_size(spark, folder):
    return tables.table_size(batter_table(spark, folder))


@query
def layout_file_count(spark, folder):
    first = sampling.earliest(adapter.season_balls(spark, folder), "season").select("season", "match_id", "runs_total")
    return tables.files_per_layout(settled(first), fresh_path(spark, "layout"), (4, 16))


@query
def lineage_columns(spark, folder):
    payload = F.struct("o_orderkey", "o_orderstatus", "o_orderpriority")
    traced = lineage.with_lineage(lineage.with_source_path(table(spark, folder, "orders")), payload)
    return traced.select(
        "o_orderkey", "src_file_name", "src_record_hash", F.col("src_ingest_ts").isNotNull().alias("has_ingest_ts")
    )


@query
def preview_topn(spark, folder):
    rows = adapter.season_balls(spark, folder).select(*SAMPLE_COLUMNS)
    return explore.preview(rows, 20, "match_id", "inning_no", "over_no", F.desc("ball_in_over"), *SAMPLE_COLUMNS[4:])


@query
def sample_by_keys(spark, folder):
    rows = adapter.line_balls(spark, folder)
    ids = sampling.first_keys(rows, "match_id", 20)
    return sampling.rows_of(rows, ids, "match_id").select("match_id", "inning_no", "over_no", "ball_in_over", "striker")


# ------------------------------------------- projection and flattening

BALL_COLUMNS = (
    "match_id", "season", "inning_no", "over_no", "ball_in_over", "batting_team", "bowling_team", "striker", "non_striker", "bowler",
    "runs_batter", "runs_extras", "runs_total", "extra_byes", "extra_legbyes", "extra_wides", "extra_noballs",
    "wicket_fell", "wicket_player_out", "wicket_kind", "delivery_id",
)


# The fielders as text, to compare across engines, and where a ball came from.
BALL_LINEAGE = ("to_json(wicket_fielders) AS wicket_fielders", "src_file_path", "src_file_name", "src_record_hash")


@query
def bronze_matches(spark, folder):
    """All but the nested officials, which are text, and the time of the run."""
    rows = flatten.match_rows(adapter.order_documents(spark, folder))
    return rows.withColumn("officials", F.to_json("officials")).drop("src_ingest_ts")


@query
def bronze_officials(spark, folder):
    """The officials of each match pass through as a nested value."""
    rows = flatten.match_rows(adapter.order_documents(spark, folder))
    return rows.select("match_id", F.get("officials.umpires", F.lit(0)).alias("umpire"))


@query
def bronze_deliveries(spark, folder):
    rows = flatten.ball_rows(adapter.order_documents(spark, folder))
    return rows.selectExpr(*BALL_COLUMNS, "get(wicket_fielders, 0).name AS first_fielder", *BALL_LINEAGE)


@query
def flatten_ordinals(spark, folder):
    rows = flatten.ball_rows(adapter.order_documents(spark, folder))
    return rows.groupBy("inning_no", "over_no", "ball_in_over").agg(F.count(F.lit(1)).alias("rows"))


@query
def array_element(spark, folder):
    """First, second and a too distant element of an array."""
    vectors = table(spark, folder, "embeddings")
    return vectors.select(
        "vec_id",
        *(flatten.nth(F.col("embedding"), n).cast("double").alias(f"item{n}") for n in (1, 2, 100000)),
    )


@query
def bowling_team(spark, folder):
    matches = adapter.bronze_matches(spark, folder)
    batting = F.when(F.col("result").isNotNull(), F.col("winner"))
    return matches.select(
        "match_id", batting.alias("batting_team"),
        flatten.opponent(batting, F.col("team1"), F.col("team2")).alias("bowling_team"),
    )


@query
def wicket_flag(spark, folder):
    """Balls with and without wicket: none, an empty list, one and two."""
    rows = flatten.ball_rows(adapter.order_documents(spark, folder))
    return rows.where("delivery_id is not null").groupBy("season", "wicket_fell", "wicket_kind").agg(
        F.count(F.lit(1)).alias("balls")
    )


@query
def result_kind_margin(spark, folder):
    rows = flatten.match_rows(adapter.order_documents(spark, folder))
    return rows.select("match_id", "winner", "result", "result_margin")


@query
def season_label(spark, folder):
    orders = table(spark, folder, "orders")
    year = F.year("o_orderdate")
    raw = F.when(
        F.col("o_orderkey") % 2 == 0, F.concat(year.cast("string"), F.lit("/"), F.lpad(((year + 1) % 100).cast("string"), 2, "0"))
    ).otherwise(year.cast("string"))
    return orders.select("o_orderkey", text_fn.season_label(raw).alias("season"))


@query
def match_key(spark, folder):
    matches = adapter.bronze_matches(spark, folder)
    parts = (F.col(c) for c in ("season", "team1", "team2", "winner", "match_start_date"))
    return matches.select("match_id", key_fn.match_key(*parts).alias("match_key"))


@query
def delivery_key(spark, folder):
    rows = adapter.line_balls(spark, folder)
    over = F.when(F.col("over_no") < 20, F.col("over_no"))
    return rows.select(
        "match_id", "over_no", "ball_in_over", "runs_total",
        key_fn.ball_key(F.col("match_id"), F.col("inning_no"), over, F.col("ball_in_over")).alias("delivery_id"),
    )


@query
def path_basename(spark, folder):
    return table(spark, folder, "pages").select("page_id", key_fn.base_name(F.col("url")).alias("base_name"))


@query
def record_hash(spark, folder):
    payload = F.when(F.col("event_type") != "error", F.struct("event_id", "event_type", "user_id"))
    return table(spark, folder, "events").select("event_id", key_fn.record_hash(payload).alias("record_hash"))


SILVER_BALL_COLUMNS = tuple(c for c in BALL_COLUMNS if c != "delivery_id") + ("delivery_id",)


@query
def silver_deliveries(spark, folder):
    raw = flatten.ball_rows(adapter.order_documents(spark, folder))
    return conform.silver_deliveries(raw).selectExpr(*SILVER_BALL_COLUMNS, *BALL_LINEAGE)


@query
def silver_matches(spark, folder):
    lineage_columns = [c for c in schemas.SILVER_MATCHES.fieldNames() if c.startswith("src_")]
    return silver_match_table(spark, folder).drop(*lineage_columns)


@query
def silver_matches_documents(spark, folder):
    """Documents to silver matches, batting order from their own balls."""
    docs = adapter.order_documents(spark, folder)
    rows = conform.silver_matches(flatten.match_rows(docs), flatten.ball_rows(docs))
    lineage_columns = ("src_file_path", "src_file_name", "src_record_hash")
    return rows.select("match_id", "season", "match_start_dt", "match_end_dt", "first_batting_team", "second_batting_team", *lineage_columns)


# -------------------------------------------------- scalar functions


@query
def enum_normalize(spark, folder):
    matches = adapter.bronze_matches(spark, folder)
    return matches.select(
        "match_id",
        parsing.enum_value(F.col("toss_decision"), parsing.TOSS_DECISIONS).alias("toss_decision_std"),
        parsing.enum_value(F.col("toss_decision"), {}).alias("toss_decision_clean"),
        parsing.enum_value(F.col("result"), parsing.RESULT_KINDS).alias("result_std"),
    )


@query
def date_parse_multi(spark, folder):
    matches = adapter.bronze_matches(spark, folder)
    return matches.select(
        "match_id",
        parsing.first_date(F.col("match_start_date")).alias("match_start_dt"),
        parsing.first_date(F.col("match_end_date")).alias("match_end_dt"),
    )


@query
def bool_cast(spark, folder):
    raw = adapter.pick(F.col("event_id") % 5, "true", "no", "1", "maybe", None)
    return table(spark, folder, "events").select("event_id", parsing.to_flag(raw).alias("flag"))


@query
def name_normalize(spark, folder):
    """The configurable normaliser over whole documents."""
    return table(spark, folder, "documents").select("doc_id", text_fn.name_key(F.col("text")).alias("name_key"))


@query
def name_normalize_register(spark, folder):
    aliases = adapter.people_aliases(spark, folder)
    return aliases.select("identifier", "name", text_fn.name_key(F.col("name")).alias("name_key"))


@query
def name_normalize_sql(spark, folder):
    return table(spark, folder, "documents").select("doc_id", text_fn.plain_name_key(F.col("text")).alias("name_key"))


@query
def override_lookup(spark, folder):
    nations = table(spark, folder, "customer").select(
        "c_custkey", F.concat(F.lit("NATION_"), F.col("c_nationkey").cast("string")).alias("team")
    )
    noisy = nations.withColumn("team", adapter.noisy(F.col("team"), F.col("c_custkey")))
    return noisy.select(
        "c_custkey", "team", register.canonical_team(F.col("team"), adapter.NATION_OVERRIDES).alias("name_canonical")
    )


@query
def phase_bucket(spark, folder):
    rows = adapter.line_balls(spark, folder)
    over = F.when(F.col("over_no") != 3, F.col("over_no"))
    return rows.groupBy(over.alias("over_no"), metrics.phase(over).alias("phase")).agg(F.count(F.lit(1)).alias("balls"))


@query
def legal_ball_flags(spark, folder):
    return adapter.line_balls(spark, folder).select(
        "delivery_id", "striker", "extra_wides", "extra_noballs",
        metrics.faced().alias("faced"), metrics.legal().alias("legal"),
    )


@query
def runs_conceded(spark, folder):
    return adapter.line_balls(spark, folder).select(
        "delivery_id", "striker", "runs_total", metrics.charged_runs().alias("runs_conceded")
    )


@query
def bowler_wicket(spark, folder):
    return adapter.line_balls(spark, folder).select(
        "delivery_id", "striker", "wicket_kind", metrics.credited_wicket().alias("bowler_wicket")
    )


@query
def safe_div(spark, folder):
    rows = adapter.line_balls(spark, folder)
    return rows.select(
        "delivery_id", "striker", metrics.ratio(F.col("runs_total"), F.col("runs_batter")).alias("quotient")
    )


@query
def rate_metrics(spark, folder):
    per_bowler = adapter.line_balls(spark, folder).groupBy("bowler_id").agg(
        F.sum("runs_total").alias("runs"),
        metrics.tally(metrics.legal()).alias("balls"),
        metrics.tally(metrics.credited_wicket()).alias("wkts"),
    )
    runs, balls, wkts = (F.col(c) for c in ("runs", "balls", "wkts"))
    return per_bowler.select(
        "bowler_id",
        metrics.batting_rate(runs, balls).alias("batting_rate"),
        metrics.economy_rate(runs, balls).alias("economy"),
        metrics.balls_per_wicket(balls, wkts).alias("balls_per_wicket"),
        metrics.overs(balls).alias("overs"),
    )


@query
def scatter_points(spark, folder):
    events = table(spark, folder, "events").select(
        "event_id",
        F.when(F.col("event_type") == "error", F.lit("n/a")).otherwise(F.col("value").cast("string")).alias("x"),
        F.when(F.col("event_type") != "view", F.col("user_id")).alias("y"),
        (F.col("value") - 10).cast("string").alias("size"),
    )
    return explore.scatter_points(events, "x", "y", "size")


# ------------------------------------------------------------ filters


@query
def filter_multiselect(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    choices = {"priority": ["o_orderpriority"], "lacking": ["no_such_column"], "status": ["o_orderstatus"]}
    return explore.restricted(orders, choices, priority=("1-URGENT", "5-LOW"), lacking=("x",), status=())


@query
def filter_matches(spark, folder):
    matches = adapter.bronze_matches(spark, folder)
    return explore.restricted(matches, explore.MATCH_CHOICES, season=SEASONS, team=TEAMS).select("match_id", "season", "team1", "team2", "winner")


@query
def filter_players(spark, folder):
    return explore.restricted(bowler_table(spark, folder), explore.PLAYER_CHOICES, season=SEASONS, player=PLAYERS).select(
        "season", "bowler_id", "player_name", "wkts", "runs_conceded"
    )


@query
def filter_batting(spark, folder):
    return explore.restricted(batter_table(spark, folder), explore.PLAYER_CHOICES, season=SEASONS, player=PLAYERS).select(
        "season", "striker_id", "player_name", "runs"
    )


@query
def filter_team_phase(spark, folder):
    picked = {"season": SEASONS, "team": ("Team 3", "Team 11"), "phase": PHASES}
    return explore.restricted(phase_table(spark, folder), explore.PHASE_CHOICES, **picked).select(
        "season", "team_name", "phase", "runs_scored", "wkts_taken"
    )


@query
def leaderboard_min(spark, folder):
    return explore.reaching(bowler_table(spark, folder), wkts=5).select("season", "bowler_id", "wkts", "economy")


@query
def match_explorer(spark, folder):
    rows = explore.match_explorer(summary_table(spark, folder), season=SEASONS, venue=("1-URGENT",), result=("runs",))
    return rows.select("match_id", "season", "venue", "result_std", "match_start_dt", "winner", "inning1_runs")


# -------------------------------------------------- name resolution


@query
def dim_player(spark, folder):
    dim = player_dimension(spark, folder)
    return dim.withColumns({c: joined(c) for c in ("aliases_norm", "all_keys_norm")})


@query
def dim_team(spark, folder):
    dim = layers.teams(spark, folder)
    return dim.withColumn("aliases_norm", joined("aliases_norm"))


@query
def alias_keys(spark, folder):
    return register.player_alias_keys(player_dimension(spark, folder))


@query
def team_alias_keys(spark, folder):
    return register.team_alias_keys(layers.teams(spark, folder))


@query
def team_name_universe(spark, folder):
    return layers.team_names(spark, folder)


def player_keys(spark: SparkSession, folder: str) -> DataFrame:
    return register.register_keys(adapter.people(spark, folder), adapter.people_aliases(spark, folder))


def unresolved_balls(spark: SparkSession, folder: str) -> DataFrame:
    names = ("match_id", "inning_no", "over_no", "ball_in_over", "striker", "non_striker", "bowler")
    return adapter.line_balls(spark, folder).select(*names)


@query
def resolve_players_deliveries(spark, folder):
    keys = register.one_id_per_key(player_keys(spark, folder))
    rows = unresolved_balls(spark, folder)
    return register.resolve_roles(rows, keys, register.BALL_PLAYER_ROLES, settle=settled)


@query
def resolve_players_fan_out(spark, folder):
    """Every person a key may stand for: an ambiguous name repeats the row."""
    keys = register.player_alias_keys(player_dimension(spark, folder)).withColumnRenamed("player_id", "id")
    rows = unresolved_balls(spark, folder).select("match_id", "inning_no", "over_no", "ball_in_over", "bowler")
    roles = {"bowler": "bowler_id"}
    return register.resolve_roles(rows, keys, roles, comparison=text_fn.plain_name_key, settle=settled)


@query
def resolve_teams_deliveries(spark, folder):
    keys = register.team_alias_keys(layers.teams(spark, folder)).withColumnRenamed("team_id", "id")
    rows = adapter.noisy_balls(spark, folder).select("delivery_id", "striker", "batting_team", "bowling_team")
    return register.resolve_roles(rows, keys, register.BALL_TEAM_ROLES, settle=settled)


@query
def resolve_teams_matches(spark, folder):
    rows = layers.silver_matches(spark, folder).select("match_id", *register.MATCH_TEAM_COLUMNS)
    keys = register.team_alias_keys(layers.teams(spark, folder)).withColumnRenamed("team_id", "id")
    return register.resolve_roles(rows, keys, register.MATCH_TEAM_ROLES, settle=settled)


@query
def resolve_player_of_match(spark, folder):
    keys = register.one_id_per_key(player_keys(spark, folder))
    rows = adapter.bronze_matches(spark, folder).select("match_id", "player_of_match")
    return register.resolve_roles(rows, keys, register.AWARD_ROLE, settle=settled)


@query
def resolve_priority(spark, folder):
    return register.one_id_per_key(player_keys(spark, folder))


@query
def resolve_alias_first(spark, folder):
    """The other order: an alias overrides a name."""
    return register.one_id_per_key(player_keys(spark, folder), ("alias", "name", "unique_name"))


# ------------------------------------------------- gold tables, rollups


@query
def gold_batter_season(spark, folder):
    return batter_table(spark, folder)


@query
def gold_batter_season_no_dim(spark, folder):
    missing = tables.read_or_none(spark, f"{folder}/no_such_dimension.parquet")
    return season_tables.batter_season(adapter.season_balls(spark, folder), missing)


@query
def gold_bowler_season(spark, folder):
    return bowler_table(spark, folder)


@query
def gold_team_phase_season(spark, folder):
    return phase_table(spark, folder)


@query
def match_summary(spark, folder):
    return summary_table(spark, folder)


@query
def merged_batter_season(spark, folder):
    """The gold tables once more, from the stored sums per over."""
    return layers.batters(spark, folder)


@query
def merged_bowler_season(spark, folder):
    return layers.bowlers(spark, folder)


@query
def merged_team_phase_season(spark, folder):
    return layers.phases(spark, folder)


@query
def merged_match_summary(spark, folder):
    return layers.summaries(spark, folder)


@query
def chain_batter_season(spark, folder):
    """From raw files to gold: documents, bronze and silver balls, ids resolved by name, sums per over."""
    return partials.batter_season(layers.chain_sums(spark, folder), layers.named_people(spark, folder))


@query
def chain_bowler_season(spark, folder):
    return partials.bowler_season(layers.chain_sums(spark, folder), layers.named_people(spark, folder))


@query
def chain_team_phase_season(spark, folder):
    return partials.team_phase_season(layers.chain_sums(spark, folder), layers.chain_teams(spark, folder))


def delivered(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """The balls in two deliveries: the second has the odd matches of two seasons."""
    second = F.col("season").isin(*SEASONS) & (F.col("match_id").cast("bigint") % 2 == 1)
    balls = adapter.balls(spark, folder)
    return balls.where(~second), balls.where(second)


def season_refresh(spark: SparkSession, folder: str, sums: str, gold: str) -> DataFrame:
    """Take in two deliveries; the second rewrites the gold rows of the seasons it touches, no others."""
    names = layers.named_people(spark, folder)
    for delivery in delivered(spark, folder):
        rows = settled(partials.over_sums(delivery), "delivery")
        tables.write_table(rows, sums, partition_by=["season"], mode="append")
        held = tables.read_table(spark, sums, schema=rows.schema)
        touched = rows.select(F.col("season").alias("touched")).distinct()  # prunes the partitions when the join runs
        held = held.join(touched, F.col("season").eqNullSafe(F.col("touched")), "left_semi")
        record = partials.batter_season(held, names)
        tables.write_table(record, gold, partition_by=["season"], touched_partitions_only=True)
    return tables.read_table(spark, gold, schema=record.schema)


@query
def refreshed_batter_season(spark, folder):
    return season_refresh(spark, folder, fresh_path(spark, "sums"), fresh_path(spark, "gold"))


@query
def matches_played_merged(spark, folder):
    """Exact distinct counts merged from bitmaps of two deliveries that share matches."""
    balls = adapter.season_balls(spark, folder).where("striker_id is not null").select("season", "striker_id", "match_id", "ball_in_over")
    known, maps = None, []
    for part in ("ball_in_over % 2 = 0", "ball_in_over % 2 = 1"):
        rows = balls.where(part)
        new = settled(partials.numbered(rows, "match_id", known), "match-numbers")
        known = new if known is None else known.union(new)
        maps.append(settled(partials.bitmaps(rows.join(known, "match_id"), "season", "striker_id"), "bitmaps"))
    return partials.distinct_counts(maps[0].union(maps[1]), "season", "striker_id", name="matches_played")


@query
def innings_rollup(spark, folder):
    return innings_table(spark, folder).drop("src_ingest_ts")


@query
def innings_pivot(spark, folder):
    return rollups.innings_side_by_side(adapter.balls(spark, folder))


@query
def batting_order(spark, folder):
    return conform.batting_order(adapter.balls(spark, folder))


@query
def maidens(spark, folder):
    return rollups.maidens(adapter.season_balls(spark, folder))


@query
def innings_batted(spark, folder):
    played = rollups.innings_played(adapter.season_balls(spark, folder))
    return played.groupBy("season", "striker_id").agg(*rollups.appearances())


@query
def count_per_match(spark, folder):
    return rollups.balls_per_match(adapter.line_balls(spark, folder))


@query
def deliveries_per_match_stats(spark, folder):
    return rollups.spread(rollups.balls_per_match(adapter.line_balls(spark, folder)), "deliveries_count")


@query
def median_merged(spark, folder):
    """The median of balls per match, merged from a sketch per season, against the exact ranks of that value."""
    orders = table(spark, folder, "orders").select("o_orderkey", F.year("o_orderdate").alias("season"))
    lines = table(spark, folder, "lineitem").join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    counts = settled(lines.groupBy("season", "l_orderkey").agg(F.count(F.lit(1)).alias("balls")), "balls-per-match")
    found = partials.merged_quantile(settled(partials.sketches(counts, "balls", "season"), "sketches"), 0.5).first()
    value, error, every = F.lit(found.value), partials.SKETCH_ERROR, F.count(F.lit(1))
    below, upto = F.count_if(F.col("balls") < value) / every, F.count_if(F.col("balls") <= value) / every
    return counts.agg(F.lit(found.rows).cast("long").alias("matches"), ((below <= 0.5 + error) & (upto >= 0.5 - error)).alias("within_bound"))


@query
def short_innings(spark, folder):
    return rollups.short_innings(innings_table(spark, folder)).select(
        "match_id", "inning_no", "batting_team", "balls_legal"
    )


@query
def short_innings_by_season(spark, folder):
    return rollups.short_innings_by_season(innings_table(spark, folder))


@query
def shortest_innings(spark, folder):
    return rollups.shortest_innings(innings_table(spark, folder))


# ---------------------------------------------------- exploration


@query
def season_totals(spark, folder):
    runs = explore.season_total(layers.batters(spark, folder), "runs")
    wickets = explore.season_total(layers.bowlers(spark, folder), "wkts")
    return runs.join(wickets, "season", "full")


@query
def chase_summary(spark, folder):
    return explore.chase_rate(layers.summaries(spark, folder))


@query
def overview_kpis(spark, folder):
    return explore.headline_figures(
        adapter.bronze_matches(spark, folder), layers.batters(spark, folder), layers.bowlers(spark, folder)
    )


@query
def wins_by_team(spark, folder):
    return explore.value_counts(adapter.bronze_matches(spark, folder), "winner")


@query
def chase_outcomes(spark, folder):
    rows = layers.summaries(spark, folder)
    known = F.when(F.col("result_std").isNotNull(), F.col("chase_success"))
    return explore.chase_outcomes(rows.select(known.alias("chase_success")))


@query
def topk_other(spark, folder):
    return explore.top_values_and_rest(adapter.line_balls(spark, folder), "striker")


@query
def team_phase_mean(spark, folder):
    return explore.group_means(layers.phases(spark, folder), ("team_name", "phase"), ("runs_scored",))


@query
def team_rate_trend(spark, folder):
    means = explore.group_means(layers.phases(spark, folder), ("season", "team_name"), ("run_rate", "economy"))
    return means.withColumns({c: F.round(c, 6) for c in ("run_rate", "economy")})


@query
def player_comparison(spark, folder):
    return explore.player_comparison(layers.batters(spark, folder), layers.bowlers(spark, folder), PLAYERS)


@query
def top_n(spark, folder):
    rows = batter_table(spark, folder).select("season", "striker_id", "player_name", "runs", "strike_rate")
    return explore.top_n(rows, "runs", 10, tie_break=("season", "striker_id"))


@query
def option_lists(spark, folder):
    """The choices of every selector: seasons, teams, players, venues and results."""
    named_teams = adapter.teams(spark, folder)
    return explore.option_lists(
        [
            (
                layers.summaries(spark, folder),
                {
                    "season": ["season"],
                    "team": ["team1", "team2", "winner", "first_batting_team", "second_batting_team"],
                    "venue": ["venue"],
                    "result": ["result_std"],
                },
            ),
            (named_teams, {"team": ["name_canonical"]}),
            (layers.batters(spark, folder), {"season": ["season"], "player": ["player_name"]}),
            (layers.bowlers(spark, folder), {"season": ["season"], "player": ["player_name"]}),
        ]
    )


# -------------------------------------------------------- data quality


@query
def dq_null_share(spark, folder):
    return quality.null_share(
        adapter.flawed_balls(spark, folder).select(
            "match_id", "delivery_id", "runs_total", "bowling_team", "wicket_kind", "wicket_player_out", "striker"
        )
    )


BALL_KEY = ("match_id", "inning_no", "over_no", "ball_in_over")


@query
def dq_duplicates(spark, folder):
    return quality.duplicate_report(adapter.line_balls(spark, folder), BALL_KEY)


@query
def dq_duplicate_examples(spark, folder):
    return quality.duplicate_examples(adapter.line_balls(spark, folder), BALL_KEY)


@query
def dq_schema(spark, folder):
    expected = {
        "match_id": "string",
        "inning_no": "int",
        "runs_total": "bigint",
        "wicket_kind": "string",
        "wicket_fell": "boolean",
        "extra_penalty": "int",
    }
    rows = adapter.line_balls(spark, folder)
    return quality.schema_report(rows, expected).join(quality.values_present(rows, list(expected)), "column")


@query
def dq_value_distribution(spark, folder):
    return quality.value_distribution(adapter.line_balls(spark, folder), "wicket_kind", ("bowled", "caught", "lbw"))


@query
def dq_required(spark, folder):
    balls = adapter.flawed_balls(spark, folder)
    matches = adapter.bronze_matches(spark, folder)
    return quality.combine(
        [
            quality.rule_report(balls, quality.required(quality.BALL_REQUIRED)),
            quality.rule_report(
                matches, quality.required(quality.MATCH_REQUIRED) + quality.non_empty(quality.MATCH_NON_EMPTY)
            ),
        ]
    )


@query
def dq_orphans(spark, folder):
    """Balls of undecided matches are orphans of the decided ones."""
    decided = adapter.bronze_matches(spark, folder).where(F.col("result").isNotNull())
    return quality.orphans(adapter.line_balls(spark, folder), decided, "match_id").select("match_id", "delivery_id", "striker")


def bucketed_matches(spark: SparkSession, folder: str) -> DataFrame:
    return layers.bucketed(spark, folder, "matches", lambda *a: adapter.bronze_matches(*a, dealt=True), dealt=True)


def dealt_balls(spark: SparkSession, folder: str) -> DataFrame:
    return adapter.balls_of(adapter.dealt_lines(spark, folder)).drop("l_orderkey")


@query
def bucketed_orphans(spark, folder):
    """As dq_orphans, between tables in buckets by match: no shuffle."""
    balls = layers.bucketed(spark, folder, "balls", dealt_balls, dealt=True)
    decided = bucketed_matches(spark, folder).where(F.col("result").isNotNull())
    return quality.orphans(balls, decided, "match_id").select("match_id", "delivery_id", "striker")


@query
def bucketed_team_sanity(spark, folder):
    flawed = layers.bucketed(spark, folder, "flawed", adapter.flawed_balls, dealt=True)
    rows = quality.team_sanity(flawed, bucketed_matches(spark, folder))
    return rows.select("match_id", "inning_no", "ball_in_over", "batting_team", "bowling_team", "team1", "team2", "striker")


@query
def bucketed_match_scores(spark, folder):
    """Every match with the totals of its balls: grouped and joined within buckets."""
    balls = layers.bucketed(spark, folder, "balls", dealt_balls, dealt=True)
    matches = bucketed_matches(spark, folder).select("match_id", "season", "team1", "team2")
    return matches.join(rollups.innings_scores(balls), "match_id")


@query
def dq_sum_identity(spark, folder):
    return quality.rule_violations(adapter.flawed_balls(spark, folder), [quality.sum_identity()]).select(
        "match_id", "inning_no", "over_no", "ball_in_over", "runs_batter", "runs_extras", "runs_total", "striker"
    )


@query
def dq_team_sanity(spark, folder):
    rows = quality.team_sanity(adapter.flawed_balls(spark, folder), adapter.bronze_matches(spark, folder))
    return rows.select("match_id", "inning_no", "ball_in_over", "batting_team", "bowling_team", "team1", "team2", "striker")


@query
def dq_ranges(spark, folder):
    balls = adapter.flawed_balls(spark, folder)
    matches = adapter.bronze_matches(spark, folder)
    toss = quality.allowed("toss_decision", quality.TOSS_VALUES)
    return quality.combine(
        [
            quality.rule_report(balls, quality.in_range(quality.BALL_RANGES)),
            quality.rule_report(matches, [toss, quality.season_in_range()]),
        ]
    )


@query
def dq_custom_rules(spark, folder):
    """Winners are judged on matches whose second side has withdrawn."""
    withdrawn = adapter.bronze_matches(spark, folder).withColumn("team2", F.lit("nobody"))
    return quality.combine(
        [
            quality.rule_report(withdrawn, [quality.winner_is_a_team()]),
            quality.rule_report(
                adapter.flawed_balls(spark, folder), [quality.sum_identity(), quality.wicket_has_kind()]
            ),
        ]
    )


@query
def winner_reconciliation(spark, folder):
    return quality.winner_mismatches(adapter.bronze_matches(spark, folder), innings_table(spark, folder))


@query
def innings_reconciliation(spark, folder):
    return quality.innings_reconciliation(adapter.line_balls(spark, folder), innings_table(spark, folder))


# ------------------------------- jobs the configuration only declares


@query
def dq_file_coverage(spark, folder):
    path = documents.write_document_files(adapter.period_documents(spark, folder), fresh_path(spark, "documents"))
    balls = flatten.ball_rows(documents.read_documents(spark, path, "*.txt.gz"))
    return quality.file_coverage(documents.list_files(spark, path, "*.txt.gz"), balls)


@query
def manifest_new_files(spark, folder):
    """Two deliveries of files: only those of the second are new to the manifest."""
    path = fresh_path(spark, "documents")
    documents.write_document_files(layers.weekly_texts(spark, folder, "k < 150"), path, "k")
    manifest = settled(documents.manifest_rows(documents.list_files(spark, path, "*.txt.gz")))
    documents.write_document_files(layers.weekly_texts(spark, folder, "k >= 150"), path, "k")
    files = documents.list_files(spark, path, "*.txt.gz")
    new = documents.new_files(files, manifest)
    return new.agg(F.count(F.lit(1)).alias("files")).select(F.lit("new").alias("state"), "files").union(
        files.agg(F.count(F.lit(1)).alias("files")).select(F.lit("all"), "files")
    )


LARGE_FILE = 256 << 10  # compressed, some 5 MB of text
DOCUMENT_LAYERS = {"matches": lambda docs: flatten.match_rows(docs).drop("officials"), "deliveries": flatten.ball_rows}


def week_of(path):
    """Files of this view are known by the week in their folder's name."""
    return F.regexp_extract(path, r"/k=(\d+)/", 1)


@query
def ingest_increment(spark, folder):
    """Two deliveries of files. The second brings new ones, and corrects a third of those taken in: their rows are replaced."""
    corrected = lambda weekly: weekly.where("k % 3 = 2").union(adapter.changed_documents(weekly.where("k % 3 = 1")))
    files, store = fresh_path(spark, "documents"), fresh_path(spark, "store")
    documents.write_document_files(layers.weekly_texts(spark, folder, "k % 3 <> 2"), files, "k")
    ingest.ingest(spark, files, store, DOCUMENT_LAYERS, "*.txt.gz", name=week_of, parts_above=LARGE_FILE)
    documents.write_document_files(layers.weekly_texts(spark, folder, "k % 3 <> 0", corrected), files, "k")
    ingest.ingest(spark, files, store, DOCUMENT_LAYERS, "*.txt.gz", name=week_of, parts_above=LARGE_FILE)
    balls = versions.read_part(spark, store, "deliveries").groupBy("src_file_name", "match_id").agg(F.count("delivery_id").alias("balls"))
    matches = versions.read_part(spark, store, "matches").select("src_file_name", "match_id", "venue", "season")
    held = ingest.manifest(spark, store).select("src_file_name")
    return held.join(matches, "src_file_name").join(balls, ["src_file_name", "match_id"]).drop("match_id")


def write_broken(docs: DataFrame, every: int, path: str) -> DataFrame:
    """One document per file, one in ``every`` cut short; the texts as they were written, made again for whoever reads them.

    Documents may come as their texts in pieces, see :func:`layers.weekly_texts`; the last piece is the one that is cut.
    """
    if "value" not in docs.columns:
        body = F.to_json(F.struct("info", "innings"), {"pretty": "true"})
        docs = docs.sortWithinPartitions("k").select("k", F.lit(1).alias("n"), body.alias("value"), F.lit(True).alias("last"))
    texts = docs.selectExpr("k", "n", f"if(last AND k % {every} = 0, left(value, length(value) - 2), value) AS value")
    texts.select("k", "value").write.partitionBy("k").text(path, compression="gzip")
    return texts


@query
def quarantine_documents(spark, folder):
    """Some documents cannot be read: they are stored whole beside the match rows of the others."""
    files, store = fresh_path(spark, "documents"), fresh_path(spark, "store")
    texts = write_broken(layers.weekly_texts(spark, folder), 71, files)
    ingest.ingest(spark, files, store, DOCUMENT_LAYERS, "*.txt.gz", name=week_of, parts_above=LARGE_FILE)
    good = versions.read_part(spark, store, "matches").select(F.lit("good").alias("state"), "src_file_name", "venue", F.lit(None).cast("boolean").alias("whole"))
    held = ingest.quarantined(spark, store, in_pieces=True)
    written = texts.select(F.col("k").cast("string").alias("src_file_name"), "n", F.concat("value", F.lit("\n")).alias("value"))
    written = written.join(held.select("src_file_name").distinct(), "src_file_name", "left_semi")  # only their texts are made
    written = pieces.text_pieces(written, "src_file_name", ["n"], "value")
    held = pieces.text_pieces(held, "src_file_name", ["piece"], "record").withColumnRenamed("text", "record")
    equal = held.join(written, ["src_file_name", "piece"], "full").groupBy("src_file_name").agg(F.every(F.col("record").eqNullSafe(F.col("text"))).alias("whole"))
    equal = settled(equal, "compared")
    return good.union(equal.select(F.lit("bad"), "src_file_name", F.lit(None).cast("string"), "whole"))


@query
def quarantine_gate(spark, folder):
    """Two folders, with less and with more bad documents than the limit: the second leaves no version."""
    outcome = []
    for every in (71, 31):
        files, store = fresh_path(spark, "documents"), fresh_path(spark, "store")
        write_broken(layers.weekly_texts(spark, folder), every, files)
        try:
            ingest.ingest(spark, files, store, DOCUMENT_LAYERS, "*.txt.gz", name=week_of, parts_above=LARGE_FILE)
        except ingest.TooManyBadDocuments:
            pass
        bad = ingest.quarantined(spark, store, in_pieces=True).where("piece = 0")
        held = ingest.manifest(spark, store).select(F.lit(False).alias("bad")).union(bad.select(F.lit(True)))
        counts = [F.count_if(~F.col("bad")).alias("files"), F.count_if("bad").alias("bad")]
        outcome.append(held.agg(F.lit(every).alias("one_in"), *counts))
    return quality.combine(outcome)


def parsed_events(spark: SparkSession, folder: str) -> DataFrame:
    """Event properties parsed leniently; every seventh text is cut short."""
    props = F.when(F.col("event_id") % 7 == 0, F.expr("left(props, length(props) - 1)")).otherwise(F.col("props"))
    parsed = table(spark, folder, "events").select(
        "event_id", documents.lenient_json(props, schemas.fields(k=schemas.INT)).alias("p")
    )
    return parsed.select("event_id", "p.*")


@query
def quarantine_split(spark, folder):
    good, bad = quality.quarantine_split(parsed_events(spark, folder), documents.CORRUPT)
    kept = good.select("event_id", F.lit("good").alias("state"), "k", F.lit(None).cast("string").alias("record"))
    return kept.union(bad.select("event_id", F.lit("bad"), "k", documents.CORRUPT))


@query
def quarantine_rate(spark, folder):
    return quality.quarantine_rate(parsed_events(spark, folder), documents.CORRUPT)
