"""Versions of tables, and ingest of files that come, change and break."""

import json
import os
import threading

import pytest
from pyspark.sql import functions as F

from creaseline.operators import flatten
from creaseline.sources import documents, ingest, tables, versions


@pytest.fixture
def path(tmp_path):
    return str(tmp_path / "table")


def replace(spark, path, low, high):
    return tables.replace_table(spark.range(low, high).repartition(3), path)


def ids(df):
    return sorted(r.id for r in df.collect())


def test_an_open_reader_finishes_on_its_version(spark, path):
    replace(spark, path, 0, 5)
    opened = tables.read_table(spark, path)
    replace(spark, path, 10, 12)
    assert ids(opened) == [0, 1, 2, 3, 4]
    assert ids(tables.read_table(spark, path)) == [10, 11]
    first = versions.read_version(spark, path, 1)
    assert ids(versions.read_part(spark, path, version=first)) == [0, 1, 2, 3, 4]


def test_a_table_may_be_replaced_by_what_it_reads(spark, path):
    replace(spark, path, 0, 3)
    tables.replace_table(tables.read_table(spark, path).select((F.col("id") * 2).alias("id")), path)
    assert ids(tables.read_table(spark, path)) == [0, 2, 4]


def test_a_plain_table_becomes_versioned(spark, path):
    tables.write_table(spark.range(4), path)
    assert ids(tables.read_table(spark, path)) == [0, 1, 2, 3]
    tables.replace_table(tables.read_table(spark, path).where("id > 1"), path)
    assert ids(tables.read_table(spark, path)) == [2, 3]
    with pytest.raises(ValueError):
        tables.write_table(spark.range(1), path)


def test_the_second_of_two_writers_fails_and_changes_nothing(spark, path):
    replace(spark, path, 0, 2)
    start = versions.latest(spark, path)
    mine = versions.write_segment(spark.range(7, 8), path)
    replace(spark, path, 5, 6)
    with pytest.raises(versions.VersionTaken):
        versions.commit(spark, path, {versions.ROWS: [mine]}, start)
    assert ids(tables.read_table(spark, path)) == [5]


def test_a_rename_onto_a_taken_number_fails(spark, path, monkeypatch):
    replace(spark, path, 0, 2)
    start = versions.Version()
    monkeypatch.setattr(versions, "version_numbers", lambda *a: [])  # as a writer sees that looked a moment too early
    with pytest.raises(versions.VersionTaken):
        versions.commit(spark, path, {versions.ROWS: []}, start)
    left = os.listdir(f"{path}/{versions.VERSIONS}")
    assert [x for x in left if not x.startswith(".")] == [f"{1:020d}"]


def test_readers_always_see_one_whole_version(spark, path):
    replace(spark, path, 0, 10)
    seen, stop = [], threading.Event()

    def read():
        while not stop.is_set():
            seen.append(ids(tables.read_table(spark, path)))

    reader = threading.Thread(target=read)
    reader.start()
    for k in range(1, 5):
        replace(spark, path, 100 * k, 100 * k + 10)
    stop.set()
    reader.join()
    assert seen and all(rows == list(range(rows[0], rows[0] + 10)) for rows in seen)


def test_expire_keeps_what_is_listed(spark, path):
    for k in range(4):
        replace(spark, path, k, k + 1)
    two = versions.latest(spark, path)
    more = versions.write_segment(spark.range(50, 51), path)
    versions.commit(spark, path, {versions.ROWS: [*two.parts[versions.ROWS], more]}, two)
    assert versions.expire(spark, path, 1) == [1, 2, 3, 4]
    assert ids(tables.read_table(spark, path)) == [3, 50]
    assert versions.version_numbers(spark, path) == [5]
    with pytest.raises(ValueError):
        versions.expire(spark, path, 0)


# ---------------------------------------------------------------- ingest

LAYERS = {"matches": flatten.match_rows, "deliveries": flatten.ball_rows}


def document(venue, balls=1):
    ball = {"batter": "a", "bowler": "b", "non_striker": "c", "runs": {"batter": 1, "extras": 0, "total": 1}}
    info = {"season": "2020", "venue": venue, "teams": ["x", "y"], "dates": ["2020-01-01"]}
    return json.dumps({"info": info, "innings": [{"team": "x", "overs": [{"over": 0, "deliveries": [ball] * balls}]}]}, indent=1)


def put(folder, name, text, age):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text(text)
    os.utime(folder / name, (age, age))


def state(spark, store):
    matches = {r.src_file_name: r.venue for r in versions.read_part(spark, store, "matches").collect()}
    balls = {r.src_file_name: r["count"] for r in versions.read_part(spark, store, "deliveries").groupBy("src_file_name").count().collect()}
    return matches, balls, {r.src_file_name for r in ingest.manifest(spark, store).collect()}


def test_new_changed_and_equal_files(spark, tmp_path, path):
    folder = tmp_path / "in"
    run = lambda: ingest.ingest(spark, str(folder), path, LAYERS)
    for name in "abc":
        put(folder, f"{name}.json", document(name), 1000)
    first = run()
    assert (first.files, first.replaced, first.good, first.bad) == (3, 0, 3, 0)
    put(folder, "d[1] {x}.json", document("d"), 1500)
    second = run()
    assert (second.files, second.replaced) == (1, 0)
    kept = set(second.version.parts["deliveries"])
    assert kept >= set(first.version.parts["deliveries"])

    put(folder, "b.json", document("b2", 3), 2000)
    put(folder, "e.json", document("e"), 2000)
    (folder / "c.json").unlink()
    third = run()
    assert (third.files, third.replaced) == (2, 1)
    matches, balls, held = state(spark, path)
    assert matches == {"a.json": "a", "b.json": "b2", "c.json": "c", "d[1] {x}.json": "d", "e.json": "e"}
    assert balls == {"a.json": 1, "b.json": 3, "c.json": 1, "d[1] {x}.json": 1, "e.json": 1}
    assert held == set(matches)
    untouched = set(second.version.parts["deliveries"]) - set(first.version.parts["deliveries"])
    assert untouched <= set(third.version.parts["deliveries"])
    assert not set(first.version.parts["deliveries"]) & set(third.version.parts["deliveries"])

    assert run() == ingest.Ingested(third.version)
    put(folder, "a.json", document("a3"), 3000)  # its rows lie in a rewritten segment now
    assert run().replaced == 1
    assert state(spark, path)[0]["a.json"] == "a3"


def test_bad_documents_are_kept_whole_below_the_limit(spark, tmp_path, path):
    folder = tmp_path / "in"
    for k in range(100):
        put(folder, f"{k}.json", document(str(k)) if k else '{"info": {"season"', 1000)
    done = ingest.ingest(spark, str(folder), path, LAYERS)
    assert (done.good, done.bad) == (99, 1)
    assert [(r.src_file_name, r.record) for r in ingest.quarantined(spark, path).collect()] == [("0.json", '{"info": {"season"')]
    put(folder, "0.json", document("0"), 2000)
    ingest.ingest(spark, str(folder), path, LAYERS)
    assert ingest.quarantined(spark, path).count() == 0
    assert len(state(spark, path)[0]) == 100


def test_too_many_bad_documents_commit_nothing(spark, tmp_path, path):
    folder = tmp_path / "in"
    put(folder, "a.json", document("a"), 1000)
    first = ingest.ingest(spark, str(folder), path, LAYERS)
    for k in range(97):
        put(folder, f"{k}.json", document(str(k)), 1000)
    for name in ("x.json", "y.json", "z.json"):
        put(folder, name, " \n" if name == "x.json" else "{", 1000)
    with pytest.raises(ingest.TooManyBadDocuments):
        ingest.ingest(spark, str(folder), path, LAYERS)
    assert versions.latest(spark, path) == first.version
    assert set(state(spark, path)[0]) == {"a.json"}
    assert ingest.ingest(spark, str(folder), path, LAYERS, limit_percent=3).bad == 3
    assert sorted((r.src_file_name, r.record) for r in ingest.quarantined(spark, path).collect()) == [("x.json", " \n"), ("y.json", "{"), ("z.json", "{")]


def test_parse_happens_once(spark, tmp_path):
    put(tmp_path / "in", "a.json", document("a"), 1000)
    plan = documents.read_files(spark, [str(tmp_path / "in" / "a.json")])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json") <= 1
