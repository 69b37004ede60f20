"""Explicit schemas of raw documents and layer tables."""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DataType,
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

TEXT, INT, BIG, REAL, FLAG, DAY, TIME = (
    StringType(),
    IntegerType(),
    LongType(),
    DoubleType(),
    BooleanType(),
    DateType(),
    TimestampType(),
)


def fields(**types: DataType) -> StructType:
    return StructType([StructField(name, kind) for name, kind in types.items()])


def columns(kind: DataType, *names: str) -> dict[str, DataType]:
    """Several columns of one type, by their names in order."""
    return dict.fromkeys(names, kind)


FIELDERS = ArrayType(fields(name=TEXT, substitute=FLAG))
BALL = fields(
    batter=TEXT,
    non_striker=TEXT,
    bowler=TEXT,
    runs=fields(**columns(BIG, "batter", "extras", "total")),
    extras=fields(**columns(BIG, "byes", "legbyes", "wides", "noballs")),
    wickets=ArrayType(fields(player_out=TEXT, kind=TEXT, fielders=FIELDERS)),
)
INFO = fields(
    **columns(TEXT, "season", "match_type", "gender", "venue", "city"),
    dates=ArrayType(TEXT),
    teams=ArrayType(TEXT),
    toss=fields(winner=TEXT, decision=TEXT),
    outcome=fields(winner=TEXT, by=fields(runs=BIG, wickets=BIG)),
    player_of_match=ArrayType(TEXT),
    officials=fields(**columns(ArrayType(TEXT), "umpires", "tv_umpires", "reserve_umpires", "match_referees")),
)
MATCH_DOCUMENT = fields(
    info=INFO,
    innings=ArrayType(fields(team=TEXT, overs=ArrayType(fields(over=BIG, deliveries=ArrayType(BALL))))),
)

PEOPLE = fields(**columns(TEXT, "identifier", "name", "unique_name", "key_cricinfo", "key_cricbuzz"))
ALIASES = fields(**columns(TEXT, "identifier", "name"))

LINEAGE = {**columns(TEXT, "src_file_path", "src_file_name"), "src_ingest_ts": TIME, "src_record_hash": TEXT}

BRONZE_INNINGS = fields(
    match_id=TEXT,
    season=TEXT,
    inning_no=INT,
    batting_team=TEXT,
    **columns(INT, "runs_total", "wickets", "balls_legal"),
    overs=REAL,
    **LINEAGE,
)

SILVER_DELIVERIES = fields(
    **columns(TEXT, "delivery_id", "match_id", "season"),
    **columns(INT, "inning_no", "over_no", "ball_in_over"),
    **columns(TEXT, "batting_team", "bowling_team", "striker", "non_striker", "bowler"),
    **columns(INT, "runs_batter", "runs_extras", "runs_total", "extra_byes", "extra_legbyes", "extra_wides", "extra_noballs"),
    wicket_fell=FLAG,
    wicket_player_out=TEXT,
    wicket_kind=TEXT,
    wicket_fielders=FIELDERS,
    **LINEAGE,
)

SILVER_MATCHES = fields(
    **columns(TEXT, "match_id", "season", "match_type", "gender", "venue", "city"),
    **columns(DAY, "match_start_dt", "match_end_dt"),
    **columns(TEXT, "team1", "team2", "toss_winner", "toss_decision_std", "winner", "result_std"),
    result_margin=INT,
    **columns(TEXT, "player_of_match", "first_batting_team", "second_batting_team"),
    **LINEAGE,
)

DIM_PLAYER = fields(
    **columns(TEXT, "player_id", "name", "unique_name", "id_cricinfo", "id_cricbuzz", "name_norm", "unique_name_norm"),
    **columns(ArrayType(TEXT), "aliases_norm", "all_keys_norm"),
)

DIM_TEAM = fields(**columns(TEXT, "team_id", "name_canonical", "name_canonical_norm"), aliases_norm=ArrayType(TEXT))
