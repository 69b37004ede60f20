"""Season tables, rollups and exploration on literal balls."""

import pytest
from pyspark.sql import functions as F

from creaseline.operators import explore, quality, rollups, sampling, season_tables

BALL = (
    "season string, match_id string, inning_no int, over_no int, ball_in_over int, batting_team string, "
    "batting_team_id string, bowling_team_id string, striker string, striker_id string, bowler_id string, "
    "runs_batter int, runs_extras int, runs_total int, extra_byes int, extra_legbyes int, extra_wides int, "
    "extra_noballs int, wicket_fell boolean, wicket_player_out string, wicket_kind string"
)


def ball(place, sides, who, runs=0, kind=None, wicket=None, season="2010"):
    match, inning, over, number = place
    extras = {k: int(kind == k) for k in ("byes", "legbyes", "wides", "noballs")}
    out, how = wicket or (None, None)
    return (
        season, match, inning, over, number, sides[0], sides[0], sides[1], who[0], who[0], who[1],
        runs, int(kind is not None), runs + int(kind is not None), extras["byes"], extras["legbyes"], extras["wides"],
        extras["noballs"], wicket is not None, out, how,
    )


@pytest.fixture(scope="module")
def balls(rows):
    ab, ba = ("A", "B"), ("B", "A")
    return rows(
        BALL,
        ball(("m1", 1, 1, 1), ab, ("s", "w"), 4),
        ball(("m1", 1, 1, 2), ab, ("s", "w"), 0, "wides"),
        ball(("m1", 1, 1, 3), ab, ("s", "w"), 0, wicket=("t", "run out")),
        ball(("m1", 1, 2, 1), ab, ("t", "v"), 0, "legbyes"),
        ball(("m1", 1, 2, 2), ab, ("t", "v"), 0, wicket=("t", "Bowled")),
        ball(("m1", 2, 16, 1), ba, ("x", "s"), 6),
        ball(("m1", 3, 1, 1), ba, ("x", "s"), 6),
        ball(("m2", 1, 7, 1), ab, ("s", "w"), 1, "noballs"),
        ball(("m3", 1, 7, 1), ba, (None, None), 0, "wides"),
    )


def test_batter_season(balls, rows):
    names = rows("player_id string, name string", ("s", "Sam"))
    found = {r.striker_id: r for r in season_tables.batter_season(balls, names).collect()}
    s, t, x = found["s"], found["t"], found["x"]
    assert set(found) == {"s", "t", "x"} and (s.player_name, t.player_name) == ("Sam", None)
    # a run-out of the partner is charged to nobody; wides are not faced, no-balls are
    assert (s.matches_played, s.innings_batted, s.runs, s.balls_faced, s.fours, s.outs) == (2, 2, 5, 3, 1, 0)
    assert s.average is None and s.strike_rate == pytest.approx(500 / 3)
    assert (t.outs, t.average, x.innings_batted, x.sixes) == (1, 0.0, 2, 2)
    bare = season_tables.batter_season(balls)
    assert bare.where("player_name is not null").count() == 0 and dict(bare.dtypes)["player_name"] == "string"


def test_bowler_season(balls):
    found = {r.bowler_id: r for r in season_tables.bowler_season(balls).collect()}
    v, w, s = found["v"], found["w"], found["s"]
    # leg-byes are not conceded: v's over is a maiden although it has only two balls
    assert (v.maidens, v.runs_conceded, v.balls_bowled, v.wkts, v.economy) == (1, 0, 2, 1, 0.0)
    assert (w.maidens, w.runs_conceded, w.balls_bowled, w.wkts) == (0, 7, 2, 0)
    assert w.average is None and w.strike_rate is None and w.overs_bowled == pytest.approx(2 / 6)
    assert (s.runs_conceded, s.economy) == (12, 36.0)
    assert rollups.maidens(balls).where("bowler_id = 'v'").first().maidens == 1


def test_team_phase_season(balls, rows):
    names = rows("team_id string, name_canonical string", ("A", "Alpha"))
    found = {(r.team_id, r.phase): r for r in season_tables.team_phase_season(balls, names).collect()}
    a = found["A", "PP"]
    assert (a.team_name, a.runs_scored, a.balls_faced, a.wickets_lost, a.fours) == ("Alpha", 6, 4, 2, 1)
    assert (a.runs_conceded, a.balls_bowled, a.overs_bowled, a.economy) == (6, 1, pytest.approx(1 / 6), 36.0)
    # B batted only in the death overs and A never did
    death = found["A", "DEATH"]
    assert (death.runs_scored, death.balls_faced, death.overs_faced, death.run_rate) == (0, 0, None, None)
    assert (death.runs_conceded, death.wkts_taken) == (6, 0)
    wide_only = found["B", "MID"]
    assert (wide_only.balls_faced, wide_only.overs_faced, wide_only.run_rate) == (0, 0.0, None)
    assert found["B", "PP"].wkts_taken == 1


MATCH = (
    "match_id string, season string, team1 string, team1_id string, team2 string, team2_id string, winner string, "
    "winner_id string, result_std string, match_start_dt date, venue string, city string, first_batting_team string, "
    "first_batting_team_id string, second_batting_team string, second_batting_team_id string"
)


@pytest.fixture(scope="module")
def matches(rows):
    def match(name, winner, result):
        return (name, "2010", "A", "A", "B", "B", winner, winner, result, None, "V", "C", "A", "A", "B", "B")

    return rows(MATCH, match("m1", "B", "wickets"), match("m2", "A", "runs"), match("m9", None, None))


def test_match_summary(matches, balls):
    found = {r.match_id: r for r in season_tables.match_summary(matches, balls).collect()}
    m1, m2, m9 = found["m1"], found["m2"], found["m9"]
    assert (m1.inning1_runs, m1.inning1_wkts, m1.inning1_balls, m1.inning2_runs, m1.inning2_balls) == (6, 2, 4, 6, 1)
    assert (m1.chase_success, m2.chase_success, m9.chase_success) == (True, False, False)
    assert m2.inning2_runs is None and m9.inning1_runs is None
    assert rollups.innings_side_by_side(balls).where("match_id = 'm1'").first().inning2_bat_team == "B"


def test_innings_reconcile(balls):
    innings = rollups.innings_rollup(balls)
    assert quality.innings_reconciliation(balls, innings).where("not runs_match or not wkts_match").count() == 0
    wrong = innings.withColumn("runs_total", F.col("runs_total") + 1)
    assert quality.innings_reconciliation(balls, wrong).where("runs_match").count() == 0
    assert rollups.shortest_innings(innings, 2).count() == 2


def test_winner_mismatches(rows):
    matches = rows(
        "match_id string, season string, result string, winner string",
        ("r", "1", "runs", "A"), ("s", "1", "runs", "B"), ("w", "1", "wickets", "A"), ("t", "1", "runs", "A"), ("n", "1", None, None),
    )
    innings = rows(
        "match_id string, inning_no int, batting_team string, runs_total int",
        *((m, i, team, 100 + extra) for m in "rsw" for i, team, extra in ((1, "A", 5), (2, "B", 0))),
        ("t", 1, "A", 90), ("t", 2, "B", 90),
    )
    found = {r.match_id: r.expected_winner for r in quality.winner_mismatches(matches, innings).collect()}
    assert found == {"s": "A", "w": "B"}  # a tie names no winner and is no mismatch


def test_filters(rows):
    df = rows("season string, team1 string, team2 string, winner string", ("1", "A", "B", None), ("2", "C", "D", "A"), (None, "A", "C", "C"))
    count = lambda table=df, **picked: explore.restricted(table, explore.MATCH_CHOICES, **picked).count()
    assert count(season=()) == count(nothing=("1",)) == count(season=(explore.ALL,)) == 3
    assert count(season=("1", "None")) == 1
    assert count(df.withColumn("season", F.col("season").cast("int")), season=("2",)) == 1
    assert count(team=("A",)) == 3
    assert count(season=("2",), team=("B",)) == 0
    assert count(df.select("season"), team=("A",)) == 3
    assert explore.reaching(df, runs=3).count() == 3 and explore.reaching(df, season=2).count() == 1


def test_top_n_and_values(rows):
    df = rows("k string, v int", ("a", 3), ("b", None), ("c", 5), ("d", 3))
    assert [r.k for r in explore.top_n(df, "v", 4, tie_break=["k"]).collect()] == ["c", "a", "d", "b"]
    assert [r.k for r in explore.top_n(df, "v", 4, ascending=True, tie_break=["k"]).collect()] == ["a", "d", "c", "b"]
    assert explore.top_n(df, "w").count() == 0
    counts = [tuple(r) for r in explore.value_counts(df, "v", "n").collect()]
    assert counts == [(3, 2), (5, 1)]
    rest = {r.value: r["count"] for r in explore.top_values_and_rest(df, "v", 1).collect()}
    assert rest == {"3": 2, "Other": 2}
    assert {r.value for r in explore.top_values_and_rest(df, "v", 3).collect()} == {"3", "5", None}


def test_chase_outcomes_and_rate(rows):
    df = rows("season string, chase_success boolean", ("1", True), ("1", False), ("2", None), (None, True))
    assert {r.chase_success: r.matches for r in explore.chase_outcomes(df).collect()} == {
        "Successful": 2, "Not Successful": 1, "Unknown": 1
    }
    assert [tuple(r) for r in explore.chase_rate(df).collect()] == [("1", 50.0), ("2", None)]


def test_comparison_and_totals(rows):
    bat = rows("season string, player_name string, runs bigint, balls_faced bigint, fours bigint, sixes bigint",
               ("1", "P", 10, 5, 1, 0), ("2", "P", 1, 5, 0, 0), ("1", "Z", 7, 7, 0, 0), (None, "Q", 5, 5, 0, 0))
    bowl = rows("season string, player_name string, wkts bigint, balls_bowled bigint, runs_conceded bigint", ("1", "Q", 2, 6, 9))
    found = {r.player_name: r.asDict() for r in explore.player_comparison(bat, bowl, ("P", "Q")).collect()}
    assert found["P"]["runs"] == 11 and found["P"]["wickets"] == 0 and found["Q"]["wickets"] == 2 and "Z" not in found
    assert [tuple(r) for r in explore.season_total(bat, "runs").collect()] == [("1", 17), ("2", 1)]


def test_headline_figures(rows, matches):
    bat, bowl = rows("runs bigint", (5,), (7,)), rows("wkts bigint", (None,))
    found = {r.metric: r.value for r in explore.headline_figures(matches, bat, bowl).collect()}
    assert found == {"Matches": 3, "Seasons": 1, "Teams": 2, "Runs": 12, "Wickets": 0}


def test_scatter_points(rows):
    df = rows("x string, y string, s string", ("1.5", "2", "-3"), ("n/a", "2", "1"), ("1", None, "1"), ("2", "3", "oops"), ("2", "3", "4"))
    found = sorted(tuple(r) for r in explore.scatter_points(df, "x", "y", "s").collect())
    assert found == [(1.5, 2.0, 0.0), (2.0, 3.0, 0.0), (2.0, 3.0, 4.0)]


def test_options_and_named_tables(rows):
    a, b = rows("t string, u string", ("x", None), ("z", "y")), rows("v int", (1,))
    assert [r.option for r in explore.distinct_options([(a, ["t", "u", "w"]), (b, ["v"])]).collect()] == ["1", "x", "y", "z"]
    with pytest.raises(ValueError):
        explore.distinct_options([(a, ["none"])])
    named = {"a": lambda: a, "b": lambda: 1 / 0}
    assert explore.named_table(named, "a") is a and explore.named_table(named, "c") is None


def test_group_means(rows):
    df = rows("t string, p string, v int", ("a", "PP", 1), ("a", "PP", 2), ("a", None, 9), (None, "PP", 9))
    assert [tuple(r) for r in explore.group_means(df, ("t", "p"), ("v",)).collect()] == [("a", "PP", 1.5)]


def test_samples(rows):
    df = rows("k string, s string", ("b", "2"), ("a", "1"), ("a", "3"), ("c", "1"), (None, "0"))
    keys = sampling.first_keys(df, "k", 2)
    assert sorted(r.k for r in sampling.rows_of(df, keys, "k").collect()) == ["a", "a", "b"]
    assert {r.k for r in sampling.earliest(df.where("k is not null"), "s").collect()} == {"a", "c"}
    assert [r.k for r in sampling.head_in_order(df, 2, F.asc_nulls_last("k"), "s").collect()] == ["a", "a"]


def test_spread_statistics(balls):
    row = rollups.spread(rollups.balls_per_match(balls), "deliveries_count").first()
    assert (row["min"], row["median"], row["max"], row["avg"]) == (1, 1, 7, 3.0)
