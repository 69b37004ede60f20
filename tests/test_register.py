"""Dimensions and name resolution."""

import hashlib

import pytest
from pyspark.sql import functions as F

from creaseline.functions.text import plain_name_key
from creaseline.operators import register


@pytest.fixture(scope="module")
def people(rows):
    return rows(
        "identifier string, name string, unique_name string, key_cricinfo string, key_cricbuzz string",
        ("p1", "José Silva", "J Silva", "11", None),
        ("p2", "A Kumar", "A Kumar (2)", None, "22"),
        ("p3", None, "No Name", None, None),
        ("p4", "Alone", "Alone", None, None),
    )


@pytest.fixture(scope="module")
def aliases(rows):
    return rows(
        "identifier string, name string",
        ("p1", "J. Silva,"), ("p1", "Jose\t  Silva"), ("p1", "JOSÉ SILVA"),
        ("p2", "Kumar"), ("p3", "Kumar"), ("p1", "Kumar"), ("p3", "A Kumar"), ("p2", None), ("p2", ""),
    )


@pytest.fixture(scope="module")
def dim(people, aliases):
    return register.dim_player(people, aliases)


def test_dim_player(dim):
    found = {r.player_id: r for r in dim.collect()}
    assert found["p1"].aliases_norm == ["j. silva", "jose silva", "kumar"]
    assert found["p1"].all_keys_norm == ["jose silva", "j silva", "j. silva", "kumar"]
    assert (found["p3"].name_norm, found["p3"].all_keys_norm) == (None, [None, "no name", "a kumar", "kumar"])
    assert found["p4"].aliases_norm == [] and found["p4"].all_keys_norm == ["alone"]
    assert found["p2"].id_cricbuzz == "22"


def test_dim_player_without_external_ids(people, aliases):
    row = register.dim_player(people, aliases, id_cricinfo=None, id_cricbuzz=None).first()
    assert row.id_cricinfo is None and row.id_cricbuzz is None


def test_alias_keys_have_no_null(dim):
    keys = register.player_alias_keys(dim)
    assert keys.where("key is null").count() == 0
    assert {r.player_id for r in keys.where("key = 'kumar'").collect()} == {"p1", "p2", "p3"}


def test_one_id_per_key_follows_the_order(people, aliases):
    keys = register.register_keys(people, aliases)
    chosen = {r.key: r.id for r in register.one_id_per_key(keys).collect()}
    assert chosen["a kumar"] == "p2" and chosen["kumar"] == "p1" and "" not in chosen
    alias_first = {r.key: r.id for r in register.one_id_per_key(keys, ("alias", "name", "unique_name")).collect()}
    assert alias_first["a kumar"] == "p3"


def test_resolution_keeps_rows_and_is_repeatable(rows, people, aliases):
    keys = register.one_id_per_key(register.register_keys(people, aliases))
    balls = rows(
        "n int, striker string, non_striker string, bowler string",
        (1, " JOSÉ  Silva,", "Kumar", "nobody"), (2, None, "A Kumar", "A Kumar"), (3, "Alone", "Alone", None),
    )
    once = register.resolve_roles(balls, keys, register.BALL_PLAYER_ROLES)
    twice = register.resolve_roles(once, keys, register.BALL_PLAYER_ROLES)
    expected = [(1, "p1", "p1", None), (2, None, "p2", "p2"), (3, "p4", "p4", None)]
    for df in (once, twice):
        assert df.columns == [*balls.columns, "striker_id", "non_striker_id", "bowler_id"]
        found = df.select("n", "striker_id", "non_striker_id", "bowler_id").orderBy("n").collect()
        assert [tuple(r) for r in found] == expected


def test_fan_out_repeats_ambiguous_rows(rows, dim):
    keys = register.player_alias_keys(dim).withColumnRenamed("player_id", "id")
    balls = rows("n int, bowler string", (1, "Kumar"), (2, "Alone"), (3, "José Silva"))
    found = register.resolve_roles(balls, keys, {"bowler": "bowler_id"}, comparison=plain_name_key)
    assert sorted((r.n, r.bowler_id) for r in found.where("n < 3").collect()) == [(1, "p1"), (1, "p2"), (1, "p3"), (2, "p4")]
    assert found.where("n = 3").first().bowler_id is None  # the plain comparison keeps diacritics


@pytest.fixture(scope="module")
def team_dim(rows):
    matches = rows(
        "team1 string, team2 string, toss_winner string, winner string, first_batting_team string, second_batting_team string",
        ("Delhi Daredevils", "Mumbai", "mumbai ,", None, "Mumbai", "Delhi Capitals"),
        ("DELHI  daredevils,", "Chennai", "Chennai", "Chennai", None, None),
    )
    balls = rows("batting_team string, bowling_team string", ("Mumbai", "Pune"), (None, " Mumbai"))
    return register.dim_team(register.team_names(matches, balls))


def test_dim_team(team_dim):
    found = {r.name_canonical_norm: r for r in team_dim.collect()}
    assert set(found) == {"delhi capitals", "mumbai", "chennai", "pune"}
    delhi = found["delhi capitals"]
    assert (delhi.name_canonical, delhi.aliases_norm) == ("Delhi Capitals", ["delhi capitals", "delhi daredevils"])
    assert delhi.team_id == "team_" + hashlib.sha1(b"delhi capitals").hexdigest()[:12]
    assert found["mumbai"].name_canonical == " Mumbai"


def test_team_resolution(rows, team_dim):
    keys = register.team_alias_keys(team_dim).withColumnRenamed("team_id", "id")
    assert keys.groupBy("key").count().where("count > 1").count() == 0
    balls = rows("batting_team string, bowling_team string", ("Delhi Daredevils", "PUNE,"), ("Unknown", None))
    found = register.resolve_roles(balls, keys, register.BALL_TEAM_ROLES).orderBy("batting_team").collect()
    delhi = "team_" + hashlib.sha1(b"delhi capitals").hexdigest()[:12]
    assert found[0].batting_team_id == delhi and found[0].bowling_team_id.startswith("team_")
    assert found[1].batting_team_id is None and found[1].bowling_team_id is None


def test_hot_key_keeps_every_row(spark, people, aliases):
    """A third of all balls under one name, another third without any."""
    n = 30000
    name = F.when(F.col("id") % 3 == 0, "José Silva").when(F.col("id") % 3 == 1, F.concat(F.lit("x"), F.col("id").cast("string")))
    balls = spark.range(n).select("id", name.alias("bowler"))
    keys = register.one_id_per_key(register.register_keys(people, aliases))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        found = register.resolve_roles(balls, keys, {"bowler": "bowler_id"})
        assert found.count() == n and found.where("bowler_id = 'p1'").count() == n // 3
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def exchanges_of(df):
    """Exchanges below the facts' side of the last join, as the plan text has them."""
    return df._jdf.queryExecution().executedPlan().toString()


def test_facts_are_shuffled_once_for_all_roles(spark, rows, tmp_path):
    from creaseline.sources.workspace import settled

    facts = settled(rows("a string, b string, c string, other long", *((f"n{k % 5}", f"n{k % 3}", None, k) for k in range(50))), "facts")
    keys = settled(rows("id string, key string", *((f"i{k}", f"n{k}") for k in range(4))), "keys")
    before = {c: spark.conf.get(c) for c in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        found = register.resolve_roles(facts, keys, {"a": "a_id", "b": "b_id", "c": "c_id"}, settle=settled)
        plan = exchanges_of(found)
        assert plan.count("Exchange hashpartitioning") == 2  # the facts and the combinations
        assert sorted((r.other, r.a_id, r.b_id, r.c_id) for r in found.collect()) == sorted(
            (k, f"i{k % 5}" if k % 5 < 4 else None, f"i{k % 3}", None) for k in range(50)
        )
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def test_a_third_of_all_rows_under_one_name_or_none(rows):
    many = [("hot", None, k) for k in range(3000)] + [(None, None, k) for k in range(3000)] + [(f"n{k % 7}", "hot", k) for k in range(3000)]
    keys = rows("id string, key string", ("h", "hot"), ("x", "n1"), ("y", "n1"))
    found = register.resolve_roles(rows("a string, b string, k long", *many), keys, {"a": "a_id", "b": "b_id"})
    by = {}
    for r in found.collect():
        by[(r.a, r.b, r.a_id, r.b_id)] = by.get((r.a, r.b, r.a_id, r.b_id), 0) + 1
    assert by[("hot", None, "h", None)] == 3000 and by[(None, None, None, None)] == 3000
    assert by[("n1", "hot", "x", "h")] == by[("n1", "hot", "y", "h")] == sum(k % 7 == 1 for k in range(3000))
    assert sum(n for (a, *_), n in by.items() if a not in ("hot", "n1", None)) == sum(k % 7 != 1 for k in range(3000))
