"""Raw documents: scans, flattening, silver rows."""

import json

import pytest
from pyspark.sql import functions as F

from creaseline.operators import conform, flatten, quality, rollups
from creaseline.sources import documents, lineage, schemas


def ball(batter="A", bowler="Z", runs=(1, 0), **more):
    body = {
        "batter": batter, "non_striker": "B", "bowler": bowler,
        "runs": {"batter": runs[0], "extras": runs[1], "total": sum(runs)},
    }
    return body | more


def document(teams=("MI", "CSK"), innings=None, **info):
    body = {
        "season": "2007/08", "match_type": "T20", "gender": "male", "venue": "V", "city": "C",
        "dates": ["2008-04-18"], "teams": list(teams), "toss": {"winner": teams[0], "decision": "field"},
        "outcome": {"winner": teams[0], "by": {"runs": 140}}, "player_of_match": ["A"],
        "officials": {"umpires": ["U1", "U2"]},
    } | info
    return {"info": body} | ({} if innings is None else {"innings": innings})


WICKETS = [{"player_out": "A", "kind": "caught", "fielders": [{"name": "F"}]}, {"player_out": "B", "kind": "run out"}]
DOCUMENTS = {
    "a.json": document(
        innings=[
            {"team": "MI", "overs": [
                {"over": 0, "deliveries": [ball(), ball(runs=(0, 1), extras={"wides": 1}), ball(wickets=WICKETS)]},
                {"deliveries": [ball(runs=(6, 0))]},
            ]},
            {"team": "CSK", "overs": [{"over": 4, "deliveries": [ball("C", "D", (4, 0))]}]},
            {"team": "CSK", "overs": [{"over": 0, "deliveries": [ball("C", "D", (2, 0), wickets=[])]}]},
        ]
    ),
    "b.json": document(
        ("RR", "KXI"), [{"team": "RR"}, {"team": None, "overs": [{"over": 0, "deliveries": []}]}],
        season=2009, dates=["2009-01-01", "2009-01-02"], player_of_match=[], outcome={"result": "no result"},
    ),
    "c.json": document(("X", "Y"), None, season="2010", outcome={"winner": "Y", "by": {"wickets": 3}}, dates=[]),
}


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    path = tmp_path_factory.mktemp("raw")
    for name, body in DOCUMENTS.items():
        (path / name).write_text(json.dumps(body, indent=2), encoding="utf8")
    (path / "notes.txt").write_text("not a document")
    return str(path)


@pytest.fixture(scope="module")
def raw(spark, folder):
    return documents.read_documents(spark, folder)


def test_scan_is_one_row_per_file(raw):
    assert raw.count() == 3
    assert sorted(r.n for r in raw.select(F.element_at(F.split("src_file_path", "/"), -1).alias("n")).collect()) == list(DOCUMENTS)


def test_scan_of_first_files(spark, folder):
    subset = documents.read_documents(spark, folder, first=2)
    assert sorted(r.t for r in subset.select(F.col("info.teams")[0].alias("t")).collect()) == ["MI", "RR"]


def test_empty_folder_is_an_error(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        documents.read_documents(spark, str(tmp_path))


def test_match_rows(raw):
    found = {r.venue + r.team1: r for r in flatten.match_rows(raw).collect()}
    mi, rr, x = (found["V" + t] for t in ("MI", "RR", "X"))
    assert (mi.season, mi.match_start_date, mi.match_end_date) == ("2007-08", "2008-04-18", None)
    assert (mi.result, mi.result_margin, mi.player_of_match, mi.officials.umpires) == ("runs", 140, "A", ["U1", "U2"])
    assert (rr.season, rr.match_end_date, rr.result, rr.result_margin, rr.player_of_match) == ("2009", "2009-01-02", None, None, None)
    assert (x.result, x.result_margin, x.match_start_date) == ("wickets", 3, None)
    assert mi.src_file_name == "a.json" and len(mi.src_record_hash) == 16 and len(mi.match_id) == 16


def test_ball_rows(raw):
    balls = flatten.ball_rows(raw)
    real = balls.where("delivery_id is not null").orderBy("inning_no", "over_no", "ball_in_over").collect()
    places = [(r.inning_no, r.over_no, r.ball_in_over) for r in real]
    assert places == [(1, 1, 1), (1, 1, 2), (1, 1, 3), (1, 2, 1), (2, 5, 1), (3, 1, 1)]
    first, wide, wicket = real[:3]
    assert (first.striker, first.bowling_team, first.extra_wides, first.wicket_fell) == ("A", "CSK", 0, False)
    assert (wide.extra_wides, wide.extra_byes, wide.runs_total) == (1, 0, 1)
    assert (wicket.wicket_fell, wicket.wicket_player_out, wicket.wicket_kind) == (True, "A", "caught")
    assert wicket.wicket_fielders[0].name == "F" and real[-1].wicket_fell is False
    assert real[4].bowling_team == "MI"


def test_placeholders_stay_in_bronze_and_leave_in_silver(raw):
    balls = flatten.ball_rows(raw)
    empty = balls.where("delivery_id is null").collect()
    assert sorted((r.inning_no or 0, r.over_no or 0) for r in empty) == [(0, 0), (1, 0), (2, 1)]
    assert all(r.extra_wides is None for r in empty)
    silver = conform.silver_deliveries(balls)
    assert silver.count() == 6
    assert [(f.name, f.dataType) for f in silver.schema] == [(f.name, f.dataType) for f in schemas.SILVER_DELIVERIES]
    totals = {(r.batting_team, r.inning_no): r for r in rollups.innings_rollup(balls).collect()}
    assert (totals["RR", 1].balls_legal, totals["RR", 1].runs_total) == (0, None)
    assert (totals["MI", 1].balls_legal, totals["MI", 1].runs_total, totals["MI", 1].wickets) == (3, 9, 1)


def test_silver_matches(raw):
    silver = conform.silver_matches(flatten.match_rows(raw), flatten.ball_rows(raw))
    found = {r.team1: r for r in silver.collect()}
    assert (found["MI"].first_batting_team, found["MI"].second_batting_team) == ("MI", "CSK")
    assert found["X"].first_batting_team is None and found["MI"].toss_decision_std == "field"
    assert str(found["RR"].match_end_dt) == "2009-01-02"
    alone = conform.silver_matches(flatten.match_rows(raw))
    assert alone.columns == schemas.SILVER_MATCHES.fieldNames()
    assert alone.where("first_batting_team is not null").count() == 0


def test_raw_profile(raw):
    found = {r.teams[0]: (r.n_innings, r.inning1_team) for r in flatten.raw_profile(raw).collect()}
    assert found == {"MI": (3, "MI"), "RR": (2, "RR"), "X": (-1, None)}


def test_malformed_documents_are_kept_apart(spark, folder, tmp_path):
    for name, body in DOCUMENTS.items():
        (tmp_path / name).write_text(json.dumps(body))
    (tmp_path / "bad.json").write_text('{"info": {"season": ')
    scan = documents.read_documents(spark, str(tmp_path), keep_malformed=True)
    good, bad = quality.quarantine_split(scan)
    assert (good.count(), bad.count()) == (3, 1) and documents.CORRUPT not in good.columns
    rate = quality.quarantine_rate(scan).first()
    assert (rate.records, rate.quarantined, rate.percent, rate.status) == (4, 1, 25.0, "FAIL")
    kept, dropped = quality.quarantine_split(scan, on_bad="drop")
    assert (kept.count(), dropped.count()) == (3, 0)
    with pytest.raises(Exception, match="malformed record"):
        quality.quarantine_split(scan, on_bad="fail")[0].select("info").collect()
    assert quality.quarantine_split(documents.read_documents(spark, folder, keep_malformed=True), on_bad="fail")[0].count() == 3
    with pytest.raises(ValueError):
        quality.quarantine_split(scan, on_bad="ignore")


def test_register_files(spark, tmp_path):
    (tmp_path / "people.csv").write_text("identifier,name,unique_name,key_cricinfo,key_cricbuzz\np1,José,José (2),007,\n")
    row = documents.read_register(spark, str(tmp_path / "people.csv"), schemas.PEOPLE).first()
    assert (row.name, row.key_cricinfo, row.key_cricbuzz) == ("José", "007", None)


def test_manifest_sees_new_and_changed_files(spark, tmp_path):
    (tmp_path / "a.json").write_text("{}")
    (tmp_path / "b.json").write_text("{}")
    manifest = documents.manifest_rows(documents.list_files(spark, str(tmp_path)))
    manifest = spark.createDataFrame(manifest.collect(), manifest.schema)
    assert documents.new_files(documents.list_files(spark, str(tmp_path)), manifest).count() == 0
    (tmp_path / "b.json").write_text('{"info": {}}')
    (tmp_path / "c.json").write_text("{}")
    new = documents.new_files(documents.list_files(spark, str(tmp_path)), manifest)
    assert sorted(r.file_name for r in new.collect()) == ["b.json", "c.json"]


def test_rollup_lineage(rows):
    df = lineage.with_rollup_lineage(rows("a int, b string", (1, None)), "aggregate:x", ["a", "b"])
    row = df.first()
    assert (row.src_file_name, len(row.src_record_hash)) == ("aggregate:x", 40)


def test_only_new_files_are_read(spark, folder, tmp_path):
    before = documents.manifest_rows(documents.list_files(spark, folder)).limit(0)
    every, files = documents.read_new_documents(spark, folder, before)
    assert every.count() == files.count() == 3
    held = documents.manifest_rows(files)
    none, files = documents.read_new_documents(spark, folder, held)
    assert none.count() == files.count() == 0
    with pytest.raises(ValueError):
        documents.read_documents(spark, folder, first=0)
