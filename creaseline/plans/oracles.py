"""The same results in plain SQL, written independently of the operators."""

from __future__ import annotations

from creaseline.plans.adapter_sql import (
    BALLS,
    DAILY_DOCUMENTS,
    DAY,
    FLAWED_BALLS,
    LINE_BALLS,
    MATCH_RECORD,
    MATCH_SIDES,
    MATCHES,
    NOISY_BALLS,
    ORDER_DOCUMENTS,
    REGISTER,
    SILVER_MATCHES,
    WEEK,
    WEEKLY_DOCUMENTS,
    name_key,
    noisy,
    plain_name_key,
)
from creaseline.plans.catalog import BALL_COLUMNS, PLAYERS, SEASONS, SILVER_BALL_COLUMNS, TEAMS

ORACLES: dict[str, str] = {}


def with_views(*views: str) -> str:
    return "WITH " + ",".join(views) + "\n"


def quoted(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


LINES = with_views(LINE_BALLS)
ALL_BALLS = with_views(BALLS)
RAW_MATCHES = with_views(MATCH_SIDES, MATCHES)
SILVER = with_views(BALLS, SILVER_MATCHES)
FLAWED = with_views(BALLS, FLAWED_BALLS)
ORDER_DOCS = with_views(ORDER_DOCUMENTS)

LEGAL = "(extra_wides = 0 AND extra_noballs = 0)"
# Dismissals credited to the bowler, and the bounds of the phases.
CREDITED = (
    "(wicket_fell AND lower(wicket_kind) IN "
    "('bowled', 'caught', 'lbw', 'stumped', 'hit wicket', 'caught and bowled', 'hit the ball twice'))"
)
CONCEDED = "(runs_total - extra_byes - extra_legbyes)"
PHASE = "CASE WHEN over_no BETWEEN 1 AND 6 THEN 'PP' WHEN over_no BETWEEN 7 AND 15 THEN 'MID' ELSE 'DEATH' END"


def total(expression: str, where: str | None = None) -> str:
    condition = f" FILTER ({where})" if where else ""
    return f"CAST(sum({expression}){condition} AS BIGINT)"


def tally(condition: str) -> str:
    return f"CAST(count(*) FILTER ({condition}) AS BIGINT)"


BATTER = f"""batter AS (
  SELECT b.*, name AS player_name, CAST(runs AS DOUBLE) / nullif(outs, 0) AS average,
    CAST(runs AS DOUBLE) * 100 / nullif(balls_faced, 0) AS strike_rate
  FROM (SELECT season, striker_id, count(DISTINCT match_id) AS matches_played,
      count(DISTINCT (match_id, inning_no)) AS innings_batted, {total("runs_batter")} AS runs,
      {tally("extra_wides = 0")} AS balls_faced, {tally("runs_batter = 4")} AS fours,
      {tally("runs_batter = 6")} AS sixes, {tally("wicket_fell AND wicket_player_out = striker")} AS outs
    FROM balls GROUP BY season, striker_id) b
  LEFT JOIN (SELECT CAST(s_suppkey AS VARCHAR) AS player_id, s_name AS name FROM supplier) ON striker_id = player_id)"""

MAIDENS = f"""maidens AS (
  SELECT season, bowler_id, {tally("runs = 0 AND balls > 0")} AS maidens
  FROM (SELECT season, bowler_id, match_id, inning_no, over_no, sum({CONCEDED}) AS runs,
      count(*) FILTER ({LEGAL}) AS balls
    FROM balls GROUP BY season, bowler_id, match_id, inning_no, over_no)
  GROUP BY season, bowler_id)"""

BOWLER = f"""{MAIDENS},
bowler AS (
  SELECT season, bowler_id, s_name AS player_name, balls_bowled, CAST(balls_bowled AS DOUBLE) / 6 AS overs_bowled, maidens,
    runs_conceded, wkts, CAST(runs_conceded AS DOUBLE) * 6 / nullif(balls_bowled, 0) AS economy,
    CAST(runs_conceded AS DOUBLE) / nullif(wkts, 0) AS average,
    CAST(balls_bowled AS DOUBLE) / nullif(wkts, 0) AS strike_rate
  FROM (SELECT season, bowler_id, {tally(LEGAL)} AS balls_bowled, {total(CONCEDED)} AS runs_conceded,
      {tally(CREDITED)} AS wkts
    FROM balls GROUP BY season, bowler_id)
  JOIN maidens USING (season, bowler_id)
  LEFT JOIN supplier ON bowler_id = CAST(s_suppkey AS VARCHAR))"""

PHASES = f"""phases AS (
  SELECT season, team_id, 'Team ' || n_nationkey AS team_name, phase,
    coalesce(runs_scored, 0) AS runs_scored, coalesce(balls_faced, 0) AS balls_faced,
    CAST(balls_faced AS DOUBLE) / 6 AS overs_faced,
    CAST(runs_scored AS DOUBLE) * 6 / nullif(balls_faced, 0) AS run_rate, coalesce(fours, 0) AS fours,
    coalesce(sixes, 0) AS sixes, coalesce(wickets_lost, 0) AS wickets_lost,
    coalesce(runs_conceded, 0) AS runs_conceded, coalesce(balls_bowled, 0) AS balls_bowled,
    CAST(balls_bowled AS DOUBLE) / 6 AS overs_bowled,
    CAST(runs_conceded AS DOUBLE) * 6 / nullif(balls_bowled, 0) AS economy, coalesce(wkts_taken, 0) AS wkts_taken
  FROM (SELECT season, batting_team_id AS team_id, {PHASE} AS phase, {total("runs_total")} AS runs_scored,
      {tally("extra_wides = 0")} AS balls_faced, {tally("runs_batter = 4")} AS fours,
      {tally("runs_batter = 6")} AS sixes, {tally("wicket_fell")} AS wickets_lost
    FROM balls GROUP BY ALL)
  FULL JOIN (SELECT season, bowling_team_id AS team_id, {PHASE} AS phase, {total(CONCEDED)} AS runs_conceded,
      {tally(LEGAL)} AS balls_bowled, {tally(CREDITED)} AS wkts_taken
    FROM balls GROUP BY ALL) USING (season, team_id, phase)
  LEFT JOIN nation ON n_name = team_id)"""

INNINGS = f"""innings AS (
  SELECT match_id, season, inning_no, batting_team, CAST(sum(runs_total) AS INTEGER) AS runs_total,
    CAST(count(*) FILTER (wicket_fell) AS INTEGER) AS wickets, CAST(count(*) FILTER ({LEGAL}) AS INTEGER) AS balls_legal
  FROM balls GROUP BY match_id, season, inning_no, batting_team)"""

SCORES = f"""scores AS (
  SELECT match_id, {", ".join(
      f'{total("runs_total", f"inning_no = {n}")} AS inning{n}_runs, '
      f'{total("CAST(wicket_fell AS INTEGER)", f"inning_no = {n}")} AS inning{n}_wkts, '
      f'{total(f"CAST({LEGAL} AS INTEGER)", f"inning_no = {n}")} AS inning{n}_balls'
      for n in (1, 2))}
  FROM balls GROUP BY match_id)"""

SUMMARY = f"""{SCORES},
summary AS (
  SELECT match_id, season, team1, team1 AS team1_id, team2, team2 AS team2_id, winner, winner AS winner_id, result_std,
    match_start_dt, venue, city, first_batting_team, first_batting_team AS first_batting_team_id, second_batting_team,
    second_batting_team AS second_batting_team_id, inning1_runs, inning1_wkts, inning1_balls, inning2_runs,
    inning2_wkts, inning2_balls, coalesce(winner = second_batting_team, FALSE) AS chase_success
  FROM silver LEFT JOIN scores USING (match_id))"""

TEAM_NAMES = """team_names AS (
  SELECT DISTINCT team FROM (
    SELECT unnest([team1, team2, toss_winner, winner, first_batting_team, second_batting_team]) AS team FROM silver
    UNION ALL SELECT unnest([batting_team, bowling_team]) FROM noisy_balls)
  WHERE team IS NOT NULL)"""

OVERRIDE = "CASE {key} WHEN 'nation_3' THEN 'NATION_4' WHEN 'nation_7' THEN 'NATION_8' ELSE {team} END"


def filed_as(team: str) -> str:
    return OVERRIDE.format(key=name_key(team), team=team)


DIM_TEAM = f"""dim_team AS (
  SELECT 'team_' || substr(sha1(norm), 1, 12) AS team_id, name_canonical, norm AS name_canonical_norm, aliases
  FROM (SELECT {name_key("filed")} AS norm, min(filed) AS name_canonical, list(DISTINCT alias) AS aliases
    FROM (SELECT {filed_as("team")} AS filed, {name_key("team")} AS alias FROM team_names)
    GROUP BY norm)),
team_keys AS (
  SELECT DISTINCT team_id, unnest(list_append(aliases, name_canonical_norm)) AS key FROM dim_team)"""
TEAMS_BASE = with_views(BALLS, SILVER_MATCHES, NOISY_BALLS, TEAM_NAMES, DIM_TEAM)

KEYS = f"""register_keys AS (
  SELECT identifier AS id, {name_key("unique_name")} AS key, 1 AS named, 3 AS aliased FROM people
  UNION ALL SELECT identifier, {name_key("name")}, 2, 2 FROM people
  UNION ALL SELECT identifier, {name_key("name")}, 3, 1 FROM aliases),
dim_player AS (
  SELECT identifier AS player_id, p.name, unique_name, key_cricinfo AS id_cricinfo, key_cricbuzz AS id_cricbuzz,
    {name_key("p.name")} AS name_norm, {name_key("unique_name")} AS unique_name_norm, coalesce(aliases, []) AS aliases
  FROM people p LEFT JOIN (
    SELECT identifier, list(DISTINCT {name_key("name")}) FILTER (name IS NOT NULL) AS aliases
    FROM aliases GROUP BY identifier) USING (identifier)),
player_keys AS (
  SELECT DISTINCT player_id AS id, key FROM (
    SELECT player_id, unnest(list_concat([name_norm, unique_name_norm], aliases)) AS key FROM dim_player)
  WHERE key IS NOT NULL),
one_id AS (
  SELECT key, arg_min(id, (named, id)) AS id, arg_min(id, (aliased, id)) AS alias_first_id
  FROM register_keys WHERE key <> '' GROUP BY key)"""
REGISTERED = with_views(REGISTER, KEYS)


def flat(array: str) -> str:
    return f"array_to_string(list_sort({array}), '|')"


# ------------------------------------------------- scans, sources, sinks

ORACLES["scan_json_nested"] = ORDER_DOCS + f"SELECT {', '.join(BALL_COLUMNS)} FROM doc_balls"
ORACLES["scan_json_multiline"] = with_views(DAILY_DOCUMENTS) + f"SELECT {', '.join(BALL_COLUMNS)} FROM doc_balls"
ORACLES["scan_file_subset"] = f"""
SELECT 'Ground ' || k AS venue,
  CASE WHEN k % 5 = 0 THEN (2007 + k % 15) || '/' || lpad(CAST((2008 + k % 15) % 100 AS VARCHAR), 2, '0')
    ELSE CAST(2007 + k % 15 AS VARCHAR) END AS season
FROM (SELECT DISTINCT {DAY} AS k FROM orders ORDER BY CAST(k AS VARCHAR) LIMIT 50)"""
ORACLES["raw_profile"] = with_views(ORDER_DOCUMENTS) + """
SELECT replace(season, '-', '/') AS season, venue, team1 || '|' || team2 AS teams,
  CASE WHEN k % 2 = 0 THEN CAST(start_date AS VARCHAR) ELSE start_date || '|' || CAST(start_date + 1 AS DATE) END AS dates,
  CASE k % 3 WHEN 0 THEN 'bat' WHEN 1 THEN 'field' ELSE 'bowl' END AS toss_decision,
  CASE k % 3 WHEN 0 THEN team1 WHEN 1 THEN team2 END AS winner,
  CAST(CASE WHEN n_innings = 0 THEN -1 ELSE n_innings END AS INTEGER) AS n_innings,
  CASE first_side WHEN 1 THEN team1 WHEN 2 THEN team2 END AS inning1_team,
  'file:/matches/' || k || '.json' AS src_file_path
FROM keyed"""
ORACLES["scan_csv_register"] = with_views(REGISTER) + "SELECT * FROM people"
ORACLES["scan_table"] = "SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders"
ORACLES["sink_partitioned_roundtrip"] = ALL_BALLS + (
    f"SELECT season, count(*) AS balls, {total('runs_total')} AS runs, 'string' AS type FROM balls GROUP BY season"
)
ORACLES["sink_staged_overwrite"] = with_views(MATCH_SIDES) + (
    "SELECT o_orderkey, team1, lower(team1) AS team1_key, season FROM match_sides"
)
ORACLES["scan_missing_as_empty"] = (
    'SELECT \'orders\' AS "table", count(*) AS "rows" FROM orders UNION ALL SELECT \'returns\', CAST(0 AS BIGINT)'
)
SAMPLE = "match_id, inning_no, over_no, ball_in_over, striker, bowler, runs_total, season"
ORACLES["named_table_head"] = ALL_BALLS + f"SELECT {SAMPLE} FROM balls ORDER BY {SAMPLE} LIMIT 5000"
ORACLES["named_tables"] = with_views(BALLS, SILVER_MATCHES, NOISY_BALLS, TEAM_NAMES, DIM_TEAM, BATTER, BOWLER, PHASES) + " UNION ALL ".join(
    f'SELECT \'{name}\' AS "table", {count} AS "rows", CAST({width} AS INTEGER) AS "columns" FROM {view}'
    for name, view, width, count in (
        ("gold.batter_season", "batter", 12, "count(*)"), ("gold.bowler_season", "bowler", 11, "count(*)"),
        ("gold.team_phase_season", "phases", 16, "count(*)"), ("gold.match_summary", "silver", 23, "count(*)"),
        ("silver.matches", "silver", 22, "count(*)"), ("silver.dim_player", "supplier", 9, "count(*)"),
        ("silver.dim_team", "dim_team", 4, "count(*)"), ("silver.deliveries_sample", "balls", 8, "least(count(*), 5000)"),
    )
)
ORACLES["sink_versions"] = """
SELECT 'opened before' AS reader, count(*) AS "rows", CAST(sum(o_orderkey) AS BIGINT) AS keys FROM orders
UNION ALL SELECT 'second', count(*), CAST(sum(o_orderkey) AS BIGINT) FROM orders WHERE o_orderstatus <> 'O'
UNION ALL SELECT 'latest', count(*), CAST(sum(o_orderkey) AS BIGINT) FROM orders WHERE o_orderstatus = 'F'"""
ORACLES["export_csv_head"] = with_views(BALLS, BATTER) + (
    "SELECT season, striker_id, player_name, runs, balls_faced, outs FROM batter ORDER BY season, striker_id LIMIT 500"
)
ORACLES["table_size"] = with_views(BALLS, BATTER) + (
    'SELECT count(*) AS "rows", CAST(12 AS INTEGER) AS "columns" FROM batter'
)
ORACLES["layout_file_count"] = ALL_BALLS + """
SELECT CAST(p AS INTEGER) AS partitions, CAST(p AS BIGINT) AS files, "rows"
FROM (SELECT count(*) AS "rows" FROM balls WHERE season = (SELECT min(season) FROM balls)), (VALUES (4), (16)) v(p)"""
ORACLES["lineage_columns"] = """
SELECT o_orderkey, 'orders.parquet' AS src_file_name, TRUE AS has_ingest_ts,
  substr(sha1('{"o_orderkey":' || o_orderkey || ',"o_orderstatus":"' || o_orderstatus || '","o_orderpriority":"'
    || o_orderpriority || '"}'), 1, 16) AS src_record_hash
FROM orders"""
ORACLES["preview_topn"] = ALL_BALLS + (
    f"SELECT {SAMPLE} FROM balls ORDER BY match_id, inning_no, over_no, ball_in_over DESC, striker, bowler, runs_total, "
    "season LIMIT 20"
)
ORACLES["sample_by_keys"] = LINES + """
SELECT match_id, inning_no, over_no, ball_in_over, striker FROM line_balls
WHERE match_id IN (SELECT DISTINCT match_id FROM line_balls ORDER BY match_id LIMIT 20)"""

# ------------------------------------------- projection and flattening

ORACLES["bronze_matches"] = with_views(ORDER_DOCUMENTS) + """
SELECT match_id, season, 'T20' AS match_type, CASE k % 2 WHEN 0 THEN 'male' ELSE 'female' END AS gender, venue,
  CASE WHEN k % 6 <> 0 THEN 'City ' || (k % 50) END AS city, CAST(start_date AS VARCHAR) AS match_start_date,
  CASE WHEN k % 2 = 1 THEN CAST(CAST(start_date + 1 AS DATE) AS VARCHAR) END AS match_end_date, team1, team2,
  CASE WHEN k % 2 = 0 THEN team1 ELSE team2 END AS toss_winner,
  CASE k % 3 WHEN 0 THEN 'bat' WHEN 1 THEN 'field' ELSE 'bowl' END AS toss_decision,
  CASE k % 3 WHEN 0 THEN team1 WHEN 1 THEN team2 END AS winner,
  CASE k % 3 WHEN 0 THEN 'runs' WHEN 1 THEN 'wickets' END AS result,
  CAST(CASE k % 3 WHEN 0 THEN 1 + k % 90 WHEN 1 THEN 1 + k % 10 END AS INTEGER) AS result_margin,
  CASE WHEN k % 4 <> 0 THEN 'P' || (k % 200) END AS player_of_match,
  'file:/matches/' || k || '.json' AS src_file_path, k || '.json' AS src_file_name,
  substr(sha1(""" + MATCH_RECORD + """), 1, 16) AS src_record_hash, '{"umpires":["U' || (k % 40) || '"]}' AS officials
FROM keyed"""
ORACLES["bronze_officials"] = ORDER_DOCS + "SELECT match_id, 'U' || (k % 40) AS umpire FROM keyed"
BALL_ORIGIN = "fielders AS wicket_fielders, 'file:/matches/' || src_file_name AS src_file_path, src_file_name, src_record_hash"
ORACLES["bronze_deliveries"] = ORDER_DOCS + (
    f"SELECT {', '.join(BALL_COLUMNS)}, first_fielder, {BALL_ORIGIN} FROM doc_balls"
)
ORACLES["flatten_ordinals"] = ORDER_DOCS + (
    'SELECT inning_no, over_no, ball_in_over, count(*) AS "rows" FROM doc_balls GROUP BY ALL'
)
ORACLES["array_element"] = """
SELECT vec_id, CAST(embedding[1] AS DOUBLE) AS item1, CAST(embedding[2] AS DOUBLE) AS item2,
  CAST(NULL AS DOUBLE) AS item100000 FROM embeddings"""
ORACLES["bowling_team"] = RAW_MATCHES + """
SELECT match_id, winner AS batting_team, CASE WHEN winner = team1 THEN team2 ELSE team1 END AS bowling_team FROM matches"""
ORACLES["wicket_flag"] = ORDER_DOCS + """
SELECT season, wicket_fell, wicket_kind, count(*) AS balls FROM doc_balls WHERE delivery_id IS NOT NULL GROUP BY ALL"""
ORACLES["result_kind_margin"] = with_views(ORDER_DOCUMENTS) + """
SELECT match_id, CASE k % 3 WHEN 0 THEN team1 WHEN 1 THEN team2 END AS winner,
  CASE k % 3 WHEN 0 THEN 'runs' WHEN 1 THEN 'wickets' END AS result,
  CAST(CASE k % 3 WHEN 0 THEN 1 + k % 90 WHEN 1 THEN 1 + k % 10 END AS INTEGER) AS result_margin
FROM keyed"""
ORACLES["season_label"] = """
SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0
    THEN year(o_orderdate) || '-' || lpad(CAST((year(o_orderdate) + 1) % 100 AS VARCHAR), 2, '0')
    ELSE CAST(year(o_orderdate) AS VARCHAR) END AS season
FROM orders"""
ORACLES["match_key"] = RAW_MATCHES + """
SELECT match_id, substr(sha1(lower(season) || '|' || lower(team1) || '|' || lower(team2) || '|'
  || lower(coalesce(winner, '')) || '|' || lower(match_start_date)), 1, 16) AS match_key
FROM matches"""
ORACLES["delivery_key"] = LINES + """
SELECT match_id, over_no, ball_in_over, runs_total, CASE WHEN over_no < 20
  THEN match_id || printf('-%02d-%02d-%02d', inning_no, over_no, ball_in_over) END AS delivery_id
FROM line_balls"""
ORACLES["path_basename"] = r"SELECT page_id, string_split_regex(url, '[/\\]+')[-1] AS base_name FROM pages"
ORACLES["record_hash"] = """
SELECT event_id, substr(sha1(CASE WHEN event_type <> 'error' THEN '{"event_id":' || event_id || ',"event_type":"'
  || event_type || '","user_id":' || user_id || '}' ELSE '{}' END), 1, 16) AS record_hash
FROM events"""
ORACLES["silver_deliveries"] = ORDER_DOCS + (
    f"SELECT {', '.join(SILVER_BALL_COLUMNS)}, {BALL_ORIGIN} FROM doc_balls WHERE delivery_id IS NOT NULL"
)
ORACLES["silver_matches"] = SILVER + """
SELECT match_id, season, match_type, gender, venue, city, match_start_dt, match_end_dt, team1, team2, toss_winner,
  toss_decision_std, winner, result_std, result_margin, player_of_match, first_batting_team, second_batting_team
FROM silver"""
ORACLES["silver_matches_documents"] = ORDER_DOCS + """
SELECT match_id, season, start_date AS match_start_dt,
  CASE WHEN k % 2 = 1 THEN CAST(start_date + 1 AS DATE) END AS match_end_dt,
  CASE first_side WHEN 1 THEN team1 WHEN 2 THEN team2 END AS first_batting_team,
  CASE WHEN n_innings = 2 THEN team2 END AS second_batting_team, 'file:/matches/' || k || '.json' AS src_file_path,
  k || '.json' AS src_file_name, substr(sha1(""" + MATCH_RECORD + """), 1, 16) AS src_record_hash
FROM keyed"""

# -------------------------------------------------- scalar functions

ORACLES["enum_normalize"] = RAW_MATCHES + """
SELECT match_id, CASE lower(trim(toss_decision)) WHEN 'bat' THEN 'bat' WHEN 'field' THEN 'field' WHEN 'bowl' THEN 'field' END
  AS toss_decision_std, lower(trim(toss_decision)) AS toss_decision_clean, result AS result_std
FROM matches"""
ORACLES["date_parse_multi"] = SILVER + "SELECT match_id, match_start_dt, match_end_dt FROM silver"
ORACLES["bool_cast"] = """
SELECT event_id, CASE event_id % 5 WHEN 0 THEN TRUE WHEN 1 THEN FALSE WHEN 2 THEN TRUE END AS flag FROM events"""
ORACLES["name_normalize"] = f"SELECT doc_id, {name_key('text')} AS name_key FROM documents"
ORACLES["name_normalize_register"] = with_views(REGISTER) + (
    f"SELECT identifier, name, {name_key('name')} AS name_key FROM aliases"
)
ORACLES["name_normalize_sql"] = f"SELECT doc_id, {plain_name_key('text')} AS name_key FROM documents"
ORACLES["override_lookup"] = f"""
SELECT c_custkey, team, {filed_as("team")} AS name_canonical
FROM (SELECT c_custkey, {noisy("('NATION_' || c_nationkey)", "c_custkey")} AS team FROM customer)"""
ORACLES["phase_bucket"] = LINES + f"""
SELECT over_no, {PHASE} AS phase, count(*) AS balls
FROM (SELECT nullif(over_no, 3) AS over_no FROM line_balls) GROUP BY ALL"""
ORACLES["legal_ball_flags"] = LINES + f"""
SELECT delivery_id, striker, extra_wides, extra_noballs, extra_wides = 0 AS faced, {LEGAL} AS legal FROM line_balls"""
ORACLES["runs_conceded"] = LINES + f"SELECT delivery_id, striker, runs_total, {CONCEDED} AS runs_conceded FROM line_balls"
ORACLES["bowler_wicket"] = LINES + f"""
SELECT delivery_id, striker, wicket_kind, {CREDITED} AS bowler_wicket FROM line_balls"""
ORACLES["safe_div"] = LINES + """
SELECT delivery_id, striker, CAST(runs_total AS DOUBLE) / nullif(runs_batter, 0) AS quotient FROM line_balls"""
ORACLES["rate_metrics"] = LINES + f"""
SELECT bowler_id, CAST(runs AS DOUBLE) * 100 / nullif(balls, 0) AS batting_rate,
  CAST(runs AS DOUBLE) * 6 / nullif(balls, 0) AS economy, CAST(balls AS DOUBLE) / nullif(wkts, 0) AS balls_per_wicket,
  CAST(balls AS DOUBLE) / 6 AS overs
FROM (SELECT bowler_id, sum(runs_total) AS runs, count(*) FILTER ({LEGAL}) AS balls, count(*) FILTER ({CREDITED}) AS wkts
  FROM line_balls GROUP BY bowler_id)"""
ORACLES["scatter_points"] = """
SELECT event_id, value AS x, CAST(user_id AS DOUBLE) AS y, greatest(value - 10, 0) AS size
FROM events WHERE event_type NOT IN ('error', 'view')"""

# ------------------------------------------------------------ filters

ORACLES["filter_multiselect"] = """
SELECT o_orderkey, o_orderstatus, o_orderpriority FROM orders WHERE o_orderpriority IN ('1-URGENT', '5-LOW')"""
ORACLES["filter_matches"] = RAW_MATCHES + f"""
SELECT match_id, season, team1, team2, winner FROM matches WHERE season IN ({quoted(SEASONS)})
  AND (team1 IN ({quoted(TEAMS)}) OR team2 IN ({quoted(TEAMS)}) OR winner IN ({quoted(TEAMS)}))"""
ORACLES["filter_players"] = with_views(BALLS, BOWLER) + f"""
SELECT season, bowler_id, player_name, wkts, runs_conceded FROM bowler
WHERE season IN ({quoted(SEASONS)}) AND player_name IN ({quoted(PLAYERS)})"""
ORACLES["filter_batting"] = with_views(BALLS, BATTER) + f"""
SELECT season, striker_id, player_name, runs FROM batter
WHERE season IN ({quoted(SEASONS)}) AND player_name IN ({quoted(PLAYERS)})"""
ORACLES["filter_team_phase"] = with_views(BALLS, PHASES) + f"""
SELECT season, team_name, phase, runs_scored, wkts_taken FROM phases
WHERE season IN ({quoted(SEASONS)}) AND team_name IN ('Team 3', 'Team 11') AND phase IN ('PP', 'DEATH')"""
ORACLES["leaderboard_min"] = with_views(BALLS, BOWLER) + (
    "SELECT season, bowler_id, wkts, economy FROM bowler WHERE wkts >= 5"
)
ORACLES["match_explorer"] = with_views(BALLS, SILVER_MATCHES, SUMMARY) + f"""
SELECT match_id, season, venue, result_std, match_start_dt, winner, inning1_runs FROM summary
WHERE season IN ({quoted(SEASONS)}) AND venue = '1-URGENT' AND result_std = 'runs'
ORDER BY match_start_dt DESC, match_id"""

# -------------------------------------------------- name resolution

ORACLES["dim_player"] = REGISTERED + f"""
SELECT player_id, name, unique_name, id_cricinfo, id_cricbuzz, name_norm, unique_name_norm,
  {flat("aliases")} AS aliases_norm,
  {flat("list_distinct(list_concat([name_norm, unique_name_norm], aliases))")} AS all_keys_norm
FROM dim_player"""
ORACLES["dim_team"] = TEAMS_BASE + (
    f"SELECT team_id, name_canonical, name_canonical_norm, {flat('aliases')} AS aliases_norm FROM dim_team"
)
ORACLES["alias_keys"] = REGISTERED + "SELECT id AS player_id, key FROM player_keys"
ORACLES["team_alias_keys"] = TEAMS_BASE + "SELECT team_id, key FROM team_keys"
ORACLES["team_name_universe"] = with_views(BALLS, SILVER_MATCHES, NOISY_BALLS, TEAM_NAMES) + "SELECT team FROM team_names"
ORACLES["resolve_players_deliveries"] = with_views(LINE_BALLS, REGISTER, KEYS) + f"""
SELECT match_id, inning_no, over_no, ball_in_over, striker, non_striker, bowler,
  s.id AS striker_id, n.id AS non_striker_id, w.id AS bowler_id
FROM line_balls b LEFT JOIN one_id s ON s.key = {name_key("striker")}
  LEFT JOIN one_id n ON n.key = {name_key("non_striker")} LEFT JOIN one_id w ON w.key = {name_key("bowler")}"""
ORACLES["resolve_players_fan_out"] = with_views(LINE_BALLS, REGISTER, KEYS) + f"""
SELECT match_id, inning_no, over_no, ball_in_over, bowler, w.id AS bowler_id
FROM line_balls b LEFT JOIN player_keys w ON w.key = {plain_name_key("bowler")}"""
ORACLES["resolve_teams_deliveries"] = TEAMS_BASE + f"""
SELECT delivery_id, striker, batting_team, bowling_team, t.team_id AS batting_team_id, w.team_id AS bowling_team_id
FROM noisy_balls LEFT JOIN team_keys t ON t.key = {name_key("batting_team")}
  LEFT JOIN team_keys w ON w.key = {name_key("bowling_team")}"""
_TEAM_ROLES = ("team1", "team2", "toss_winner", "winner", "first_batting_team", "second_batting_team")
ORACLES["resolve_teams_matches"] = TEAMS_BASE + (
    f"SELECT match_id, {', '.join(_TEAM_ROLES)}, {', '.join(f'{r}_keys.team_id AS {r}_id' for r in _TEAM_ROLES)} FROM silver "
    + " ".join(f"LEFT JOIN team_keys {r}_keys ON {r}_keys.key = {name_key(r)}" for r in _TEAM_ROLES)
)
ORACLES["resolve_player_of_match"] = with_views(MATCH_SIDES, MATCHES, REGISTER, KEYS) + f"""
SELECT match_id, player_of_match, id AS player_of_match_id
FROM matches LEFT JOIN one_id ON key = {name_key("player_of_match")}"""
ORACLES["resolve_priority"] = REGISTERED + "SELECT key, id FROM one_id"
ORACLES["resolve_alias_first"] = REGISTERED + "SELECT key, alias_first_id AS id FROM one_id"

# ------------------------------------------------- gold tables, rollups

ORACLES["gold_batter_season"] = with_views(BALLS, BATTER) + "SELECT * FROM batter"
ORACLES["gold_batter_season_no_dim"] = with_views(BALLS, BATTER) + (
    "SELECT * REPLACE (CAST(NULL AS VARCHAR) AS player_name) FROM batter"
)
ORACLES["gold_bowler_season"] = with_views(BALLS, BOWLER) + "SELECT * FROM bowler"
ORACLES["gold_team_phase_season"] = with_views(BALLS, PHASES) + "SELECT * FROM phases"
ORACLES["match_summary"] = with_views(BALLS, SILVER_MATCHES, SUMMARY) + "SELECT * FROM summary"
for _gold in ("batter_season", "bowler_season", "team_phase_season"):
    ORACLES[f"merged_{_gold}"] = ORACLES[f"gold_{_gold}"]
ORACLES["merged_match_summary"] = ORACLES["match_summary"]
CHAIN = with_views(
    ORDER_DOCUMENTS, REGISTER.replace("THEN 'Guest' END]", "THEN 'Guest' END, 'S' || s_suppkey]"), KEYS, "team_names AS (SELECT DISTINCT unnest([team1, team2]) AS team FROM keyed)", DIM_TEAM,
    f"""balls AS (
  SELECT d.*, s.id AS striker_id, w.id AS bowler_id, t.team_id AS batting_team_id, o.team_id AS bowling_team_id
  FROM doc_balls d LEFT JOIN one_id s ON s.key = {name_key("striker")} LEFT JOIN one_id w ON w.key = {name_key("bowler")}
    LEFT JOIN team_keys t ON t.key = {name_key("batting_team")} LEFT JOIN team_keys o ON o.key = {name_key("bowling_team")}
  WHERE delivery_id IS NOT NULL)""",
    BATTER, BOWLER,
    PHASES.replace("'Team ' || n_nationkey AS team_name", "name_canonical AS team_name").replace("LEFT JOIN nation ON n_name = team_id", "LEFT JOIN dim_team USING (team_id)"),
)
ORACLES["chain_batter_season"] = CHAIN + "SELECT * FROM batter WHERE striker_id IS NOT NULL"
ORACLES["chain_bowler_season"] = CHAIN + "SELECT * FROM bowler WHERE bowler_id IS NOT NULL"
ORACLES["chain_team_phase_season"] = CHAIN + "SELECT * FROM phases WHERE team_id IS NOT NULL"
ORACLES["refreshed_batter_season"] = ORACLES["gold_batter_season"]
ORACLES["matches_played_merged"] = LINES.rstrip() + """
SELECT CAST(year(o_orderdate) AS VARCHAR) AS season, striker_id, count(DISTINCT match_id) AS matches_played
FROM line_balls JOIN orders ON l_orderkey = o_orderkey GROUP BY ALL"""
ORACLES["innings_rollup"] = with_views(BALLS, INNINGS) + """
SELECT *, CAST(balls_legal AS DOUBLE) / 6 AS overs, 'aggregate:bronze.deliveries' AS src_file_path,
  'aggregate:bronze.deliveries' AS src_file_name,
  sha1(match_id || '|' || inning_no || '|' || runs_total || '|' || wickets || '|' || balls_legal) AS src_record_hash
FROM innings"""
ORACLES["innings_pivot"] = with_views(BALLS, SCORES) + f"""
SELECT s.*, {", ".join(
    f"{n}t AS inning{i}_bat_team, {n}t AS inning{i}_bat_team_id" for i, n in ((1, "first_"), (2, "second_")))}
FROM scores s JOIN (SELECT match_id, max(batting_team) FILTER (inning_no = 1) AS first_t,
  max(batting_team) FILTER (inning_no = 2) AS second_t FROM balls GROUP BY match_id) USING (match_id)"""
ORACLES["batting_order"] = SILVER + "SELECT * FROM batting_order"
ORACLES["maidens"] = with_views(BALLS, MAIDENS) + "SELECT * FROM maidens"
ORACLES["innings_batted"] = with_views(BALLS, BATTER) + (
    "SELECT season, striker_id, matches_played, innings_batted FROM batter"
)
ORACLES["count_per_match"] = LINES + "SELECT match_id, count(*) AS deliveries_count FROM line_balls GROUP BY match_id"
ORACLES["deliveries_per_match_stats"] = """
SELECT min(n) AS min, quantile_disc(n, 0.5) AS median, max(n) AS max, avg(n) AS avg
FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey)"""
ORACLES["median_merged"] = "SELECT count(DISTINCT l_orderkey) AS matches, TRUE AS within_bound FROM lineitem JOIN orders ON l_orderkey = o_orderkey"
ORACLES["short_innings"] = with_views(BALLS, INNINGS) + """
SELECT match_id, inning_no, batting_team, balls_legal FROM innings WHERE balls_legal < 120"""
ORACLES["short_innings_by_season"] = with_views(BALLS, INNINGS) + """
SELECT season, count(*) AS innings FROM innings WHERE balls_legal < 120 GROUP BY season"""
ORACLES["shortest_innings"] = with_views(BALLS, INNINGS) + """
SELECT * FROM innings WHERE balls_legal < 120 ORDER BY balls_legal, match_id, inning_no, batting_team LIMIT 10"""

# ---------------------------------------------------- exploration

ORACLES["season_totals"] = with_views(BALLS, BATTER, BOWLER) + f"""
SELECT season, runs, wkts FROM (SELECT season, {total("runs")} AS runs FROM batter GROUP BY season)
FULL JOIN (SELECT season, {total("wkts")} AS wkts FROM bowler GROUP BY season) USING (season)"""
ORACLES["chase_summary"] = with_views(BALLS, SILVER_MATCHES, SUMMARY) + """
SELECT season, avg(CAST(chase_success AS INTEGER)) * 100 AS chase_success_rate FROM summary GROUP BY season"""
ORACLES["overview_kpis"] = with_views(BALLS, BATTER, BOWLER) + f"""
SELECT 'Matches' AS metric, count(*) AS value FROM match_sides
UNION ALL SELECT 'Seasons', count(DISTINCT season) FROM match_sides
UNION ALL SELECT 'Teams', count(DISTINCT team) FROM (SELECT unnest([team1, team2]) AS team FROM match_sides)
UNION ALL SELECT 'Runs', {total("runs")} FROM batter
UNION ALL SELECT 'Wickets', {total("wkts")} FROM bowler"""
ORACLES["wins_by_team"] = RAW_MATCHES + """
SELECT winner, count(*) AS matches FROM matches WHERE winner IS NOT NULL GROUP BY winner"""
ORACLES["chase_outcomes"] = with_views(BALLS, SILVER_MATCHES, SUMMARY) + """
SELECT CASE WHEN result_std IS NULL THEN 'Unknown' WHEN chase_success THEN 'Successful' ELSE 'Not Successful' END
  AS chase_success, count(*) AS matches FROM summary GROUP BY 1"""
ORACLES["topk_other"] = LINES + """
SELECT CASE WHEN place <= 20 THEN striker ELSE 'Other' END AS value, CAST(sum(n) AS BIGINT) AS count
FROM (SELECT striker, n, row_number() OVER (ORDER BY n DESC, striker) AS place
  FROM (SELECT striker, count(*) AS n FROM line_balls GROUP BY striker)) GROUP BY 1"""
ORACLES["team_phase_mean"] = with_views(BALLS, PHASES) + """
SELECT team_name, phase, avg(runs_scored) AS runs_scored FROM phases GROUP BY team_name, phase"""
ORACLES["team_rate_trend"] = with_views(BALLS, PHASES) + """
SELECT season, team_name, round(avg(run_rate), 6) AS run_rate, round(avg(economy), 6) AS economy
FROM phases GROUP BY season, team_name"""
ORACLES["player_comparison"] = with_views(BALLS, BATTER, BOWLER) + f"""
SELECT player_name, {", ".join(f"coalesce({c}, 0) AS {c}" for c in
    ("runs", "balls_faced", "fours", "sixes", "wickets", "balls_bowled", "runs_conceded"))}
FROM (SELECT player_name, {", ".join(f"{total(c)} AS {c}" for c in ("runs", "balls_faced", "fours", "sixes"))}
  FROM batter WHERE player_name IN ({quoted(PLAYERS)}) GROUP BY player_name)
FULL JOIN (SELECT player_name, {total("wkts")} AS wickets, {total("balls_bowled")} AS balls_bowled,
    {total("runs_conceded")} AS runs_conceded
  FROM bowler WHERE player_name IN ({quoted(PLAYERS)}) GROUP BY player_name) USING (player_name)"""
ORACLES["top_n"] = with_views(BALLS, BATTER) + """
SELECT season, striker_id, player_name, runs, strike_rate FROM batter ORDER BY runs DESC, season, striker_id LIMIT 10"""
ORACLES["option_lists"] = with_views(BALLS, SILVER_MATCHES, BATTER, BOWLER) + """
SELECT DISTINCT list, option FROM (
  SELECT 'season' AS list, season AS option FROM silver
  UNION ALL SELECT 'season', season FROM batter UNION ALL SELECT 'season', season FROM bowler
  UNION ALL SELECT 'team', unnest([team1, team2, winner, first_batting_team, second_batting_team]) FROM silver
  UNION ALL SELECT 'team', 'Team ' || n_nationkey FROM nation
  UNION ALL SELECT 'player', player_name FROM batter UNION ALL SELECT 'player', player_name FROM bowler
  UNION ALL SELECT 'venue', venue FROM silver UNION ALL SELECT 'result', result_std FROM silver)
WHERE option IS NOT NULL"""

# -------------------------------------------------------- data quality

_CHECKED = ("match_id", "delivery_id", "runs_total", "bowling_team", "wicket_kind", "wicket_player_out", "striker")
ORACLES["dq_null_share"] = FLAWED + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count(*) - count({c}) AS null_count, "
    f"CAST(count(*) - count({c}) AS DOUBLE) / count(*) * 100 AS null_percent, "
    f"CASE WHEN count(*) - count({c}) <= 0.05 * count(*) THEN 'PASS' ELSE 'FAIL' END AS status FROM flawed"
    for c in _CHECKED
)
_KEY = "match_id, inning_no, over_no, ball_in_over"
ORACLES["dq_duplicates"] = LINES + f"""
SELECT n AS total_records, u AS unique_records, n - u AS duplicate_records,
  CAST(n - u AS DOUBLE) * 100 / n AS duplicate_percent, CASE WHEN n = u THEN 'PASS' ELSE 'FAIL' END AS status
FROM (SELECT count(*) AS n FROM line_balls), (SELECT count(*) AS u FROM (SELECT DISTINCT {_KEY} FROM line_balls))"""
ORACLES["dq_duplicate_examples"] = LINES + f"""
SELECT {_KEY}, count(*) AS count FROM line_balls GROUP BY {_KEY} HAVING count(*) > 1
ORDER BY count DESC, {_KEY} LIMIT 5"""
ORACLES["dq_schema"] = LINES + """
SELECT 'match_id' AS "column", 'string' AS expected_type, 'string' AS actual_type, 'PASS' AS status,
  count(match_id) AS values_present FROM line_balls
UNION ALL SELECT 'inning_no', 'int', 'int', 'PASS', count(inning_no) FROM line_balls
UNION ALL SELECT 'runs_total', 'bigint', 'int', 'FAIL', count(runs_total) FROM line_balls
UNION ALL SELECT 'wicket_kind', 'string', 'string', 'PASS', count(wicket_kind) FROM line_balls
UNION ALL SELECT 'wicket_fell', 'boolean', 'boolean', 'PASS', count(wicket_fell) FROM line_balls
UNION ALL SELECT 'extra_penalty', 'int', 'MISSING', 'FAIL', NULL"""
ORACLES["dq_value_distribution"] = LINES + """
SELECT wicket_kind, count(*) AS count, coalesce(wicket_kind NOT IN ('bowled', 'caught', 'lbw'), FALSE) AS unexpected
FROM line_balls GROUP BY wicket_kind"""


def rule_line(rule: str, broken: str, source: str, severity: str = "error") -> str:
    return (
        f"SELECT '{rule}' AS rule, '{severity}' AS severity, count(*) AS checked, "
        f"count(*) FILTER ({broken}) AS violations, "
        f"CASE WHEN count(*) FILTER ({broken}) = 0 THEN 'PASS' ELSE 'FAIL' END AS status FROM {source}"
    )


QUALITY = with_views(BALLS, FLAWED_BALLS, MATCHES)
ORACLES["dq_required"] = QUALITY + " UNION ALL ".join(
    [rule_line(f"{c} is required", f"{c} IS NULL", "flawed") for c in
     ("delivery_id", "match_id", "over_no", "ball_in_over", "runs_total")]
    + [rule_line(f"{c} is required", f"{c} IS NULL", "matches") for c in ("match_id", "season", "team1", "team2")]
    + [rule_line(f"{c} is not empty", f"trim({c}) = ''", "matches") for c in ("team1", "team2")]
)
ORACLES["dq_orphans"] = LINES + """
SELECT match_id, delivery_id, striker FROM line_balls
WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus IN ('F', 'O'))"""
ORACLES["bucketed_orphans"] = ORACLES["dq_orphans"]
ORACLES["bucketed_match_scores"] = with_views(BALLS, MATCHES, SCORES) + """
SELECT match_id, season, team1, team2, scores.* EXCLUDE (match_id) FROM matches JOIN scores USING (match_id)"""
ORACLES["dq_sum_identity"] = FLAWED + """
SELECT match_id, inning_no, over_no, ball_in_over, runs_batter, runs_extras, runs_total, striker FROM flawed
WHERE coalesce(runs_total, 0) <> coalesce(runs_batter, 0) + coalesce(runs_extras, 0)"""
ORACLES["dq_team_sanity"] = QUALITY + """
SELECT match_id, inning_no, ball_in_over, batting_team, bowling_team, team1, team2, striker
FROM flawed LEFT JOIN (SELECT match_id, team1, team2 FROM matches) USING (match_id)
WHERE bowling_team = batting_team OR NOT (bowling_team = team1 OR bowling_team = team2)"""
ORACLES["bucketed_team_sanity"] = ORACLES["dq_team_sanity"]
_RANGES = {"over_no": (1, 50), "ball_in_over": (1, 10), "runs_batter": (0, 7), "runs_extras": (0, 7), "runs_total": (0, 10)}
ORACLES["dq_ranges"] = QUALITY + " UNION ALL ".join(
    [rule_line(f"{c} between {a} and {b}", f"{c} NOT BETWEEN {a} AND {b}", "flawed") for c, (a, b) in _RANGES.items()]
    + [
        rule_line("toss_decision is allowed", "toss_decision NOT IN ('bat', 'field')", "matches"),
        rule_line(
            "season between 2008 and 2100", "TRY_CAST(substr(season, 1, 4) AS DOUBLE) NOT BETWEEN 2008 AND 2100", "matches"
        ),
    ]
)
ORACLES["dq_custom_rules"] = QUALITY + " UNION ALL ".join(
    [
        rule_line(
            "winner is one of the teams", "result IS NOT NULL AND NOT (winner = team1 OR winner = 'nobody')", "matches", "warn"
        ),
        rule_line(
            "total is batter plus extras",
            "coalesce(runs_total, 0) <> coalesce(runs_batter, 0) + coalesce(runs_extras, 0)",
            "flawed",
        ),
        rule_line("a wicket has a kind", "wicket_fell AND wicket_kind IS NULL", "flawed", "warn"),
    ]
)
ORACLES["winner_reconciliation"] = with_views(BALLS, INNINGS, MATCHES) + """
SELECT * FROM (
  SELECT m.match_id, m.season, result, winner, one.runs_total AS innings1_runs, two.runs_total AS innings2_runs,
    CASE result WHEN 'runs' THEN CASE WHEN one.runs_total > two.runs_total THEN one.batting_team
        WHEN two.runs_total > one.runs_total THEN two.batting_team END
      WHEN 'wickets' THEN two.batting_team END AS expected_winner
  FROM matches m LEFT JOIN (SELECT * FROM innings WHERE inning_no = 1) one USING (match_id)
    LEFT JOIN (SELECT * FROM innings WHERE inning_no = 2) two USING (match_id))
WHERE winner <> expected_winner"""
ORACLES["innings_reconciliation"] = with_views(BALLS, INNINGS) + """
SELECT match_id, inning_no, runs_total AS runs_from_deliveries, wickets AS wickets_from_deliveries, runs_total, wickets,
  TRUE AS runs_match, TRUE AS wkts_match
FROM innings"""

# ------------------------------- jobs the configuration only declares

DAYS = f"WITH days AS (SELECT DISTINCT {DAY} AS k FROM orders)\n"
ORACLES["dq_file_coverage"] = DAYS + "SELECT count(*) AS files_read, count(*) AS files_in_table, 'PASS' AS status FROM days"
WEEKS = f"WITH weeks AS (SELECT DISTINCT {WEEK} AS k FROM orders)\n"
ORACLES["manifest_new_files"] = WEEKS + """
SELECT 'new' AS state, count(*) FILTER (k >= 150) AS files FROM weeks UNION ALL SELECT 'all', count(*) FROM weeks"""
ORACLES["ingest_increment"] = with_views(WEEKLY_DOCUMENTS) + """
SELECT CAST(k AS VARCHAR) AS src_file_name, 'Ground ' || n AS venue, coalesce(balls, 0) AS balls,
  CASE WHEN n % 5 = 0 THEN (2007 + n % 15) || '-' || lpad(CAST((2008 + n % 15) % 100 AS VARCHAR), 2, '0')
    ELSE CAST(2007 + n % 15 AS VARCHAR) END AS season
FROM (SELECT k, CASE k % 3 WHEN 1 THEN k + 5000 ELSE k END AS n FROM docs)
LEFT JOIN (SELECT k, count(b) AS balls FROM doc_rows GROUP BY k) USING (k)"""
ORACLES["quarantine_documents"] = WEEKS + """
SELECT CASE WHEN k % 71 = 0 THEN 'bad' ELSE 'good' END AS state, CAST(k AS VARCHAR) AS src_file_name,
  CASE WHEN k % 71 <> 0 THEN 'Ground ' || k END AS venue, CASE WHEN k % 71 = 0 THEN TRUE END AS whole
FROM weeks"""
ORACLES["quarantine_gate"] = WEEKS + """
SELECT CAST(71 AS INTEGER) AS one_in, count(*) AS files, count(*) FILTER (k % 71 = 0) AS bad FROM weeks
UNION ALL SELECT CAST(31 AS INTEGER), CAST(0 AS BIGINT), CAST(0 AS BIGINT)"""
ORACLES["quarantine_split"] = """
SELECT event_id, CASE WHEN event_id % 7 = 0 THEN 'bad' ELSE 'good' END AS state,
  CASE WHEN event_id % 7 <> 0 THEN CAST(json_extract_string(props, '$.k') AS INTEGER) END AS k,
  CASE WHEN event_id % 7 = 0 THEN left(props, length(props) - 1) END AS record
FROM events"""
ORACLES["quarantine_rate"] = """
SELECT count(*) AS records, count(*) FILTER (event_id % 7 = 0) AS quarantined,
  CAST(count(*) FILTER (event_id % 7 = 0) AS DOUBLE) * 100 / count(*) AS percent, 'FAIL' AS status
FROM events"""
