"""Raw files to gold tables through stored layers, as in the README."""

import json


from creaseline.operators import conform, flatten, quality, register, rollups, season_tables
from creaseline.sources import documents, schemas, tables
from test_documents import DOCUMENTS


def test_raw_to_gold(spark, tmp_path):
    raw_folder = tmp_path / "raw"
    raw_folder.mkdir()
    for name, body in DOCUMENTS.items():
        (raw_folder / name).write_text(json.dumps(body, indent=1))
    (tmp_path / "people.csv").write_text(
        "identifier,name,unique_name,key_cricinfo,key_cricbuzz\n1,Á,A One,,\n2,C,C Two,,\n3,Z,Zed,,\n4,D,Dee,,\n"
    )
    (tmp_path / "names.csv").write_text('identifier,name\n1,"A,"\n2,See\n4,Z\n')

    raw = documents.read_documents(spark, str(raw_folder))
    bronze_balls, bronze_matches = flatten.ball_rows(raw), flatten.match_rows(raw)
    at = lambda name: f"{tmp_path}/{name}"

    # silver, then enriched in place
    tables.write_table(conform.silver_deliveries(bronze_balls), at("balls"), partition_by=["season"])
    tables.write_table(conform.silver_matches(bronze_matches, bronze_balls), at("matches"), partition_by=["season"])
    balls = tables.read_table(spark, at("balls"), schema=schemas.SILVER_DELIVERIES)
    matches = tables.read_table(spark, at("matches"), schema=schemas.SILVER_MATCHES)

    people = documents.read_register(spark, at("people.csv"), schemas.PEOPLE)
    aliases = documents.read_register(spark, at("names.csv"), schemas.ALIASES)
    ids = register.one_id_per_key(register.register_keys(people, aliases))
    tables.write_table(register.dim_team(register.team_names(matches, balls)), at("teams"))
    teams = tables.read_table(spark, at("teams"), schema=schemas.DIM_TEAM)
    team_ids = register.team_alias_keys(teams).withColumnRenamed("team_id", "id")

    for _ in range(2):  # a second run changes nothing
        resolved = register.resolve_roles(balls, ids, register.BALL_PLAYER_ROLES)
        resolved = register.resolve_roles(resolved, team_ids, register.BALL_TEAM_ROLES)
        tables.replace_table(resolved, at("balls"), partition_by=["season"])
        balls = tables.read_table(spark, at("balls"), schema=resolved.schema)
    assert balls.count() == 6 and dict(balls.dtypes)["season"] == "string"
    matches = register.resolve_roles(matches, ids, register.AWARD_ROLE)
    matches = register.resolve_roles(matches, team_ids, register.MATCH_TEAM_ROLES)

    dim = register.dim_player(people, aliases)
    batters = {r.striker_id: r for r in season_tables.batter_season(balls, dim).collect()}
    assert (batters["1"].player_name, batters["1"].runs, batters["1"].balls_faced, batters["1"].outs) == ("Á", 8, 3, 1)
    assert batters["2"].innings_batted == 2
    bowlers = {r.bowler_id: r for r in season_tables.bowler_season(balls, dim).collect()}
    assert (bowlers["3"].wkts, bowlers["3"].runs_conceded, bowlers["4"].runs_conceded) == (1, 9, 6)
    phases = season_tables.team_phase_season(balls, teams)
    assert {r.team_name for r in phases.collect()} == {"MI", "CSK"}
    summary = {r.team1: r for r in season_tables.match_summary(matches, balls).collect()}
    assert (summary["MI"].inning1_runs, summary["MI"].inning2_runs, summary["MI"].chase_success) == (9, 4, False)
    assert summary["X"].inning1_runs is None and summary["X"].season == "2010"

    innings = rollups.innings_rollup(bronze_balls)
    assert quality.innings_reconciliation(balls, innings).where("not runs_match or not wkts_match").count() == 0
    assert quality.duplicate_report(balls, ["delivery_id"]).first().status == "PASS"
    assert quality.orphans(balls, matches, "match_id").count() == 0
    assert quality.team_sanity(balls, matches).count() == 0
    assert quality.rule_report(balls, [quality.sum_identity(), *quality.required(quality.BALL_REQUIRED)]).where("status = 'FAIL'").count() == 0
