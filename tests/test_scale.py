"""What is shuffled and how it is dealt when the tables grow."""

import datetime
import re

import pytest
from pyspark.sql import functions as F

from creaseline.operators import partials, rollups
from creaseline.plans import adapter, catalog, layers
from creaseline.sources import documents


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Forty orders of six lines each; one order and its lines lack their key."""
    path = str(tmp_path_factory.mktemp("grown"))
    day = datetime.datetime(1996, 3, 1)
    orders = [(n or None, n % 5, "FOP"[n % 3], 1.0, day + datetime.timedelta(days=9 * n), "1-URGENT") for n in range(40)]
    lines = [
        (n or None, n * 7 + i, n % 4, i % 3, float(1 + i % 4), 10.0, 0.04, 0.05, "RNA"[i % 3], "FO"[i % 2], day)
        for n in range(40)
        for i in range(6)
    ]
    tables = {
        "orders": (orders, "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string"),
        "lineitem": (
            lines,
            "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_extendedprice double, "
            "l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
        ),
        "customer": ([(n, f"c{n}", n, 1.0, "AUTO") for n in range(5)], "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"),
    }
    for name, (values, schema) in tables.items():
        spark.createDataFrame(values, schema).write.parquet(f"{path}/{name}.parquet")
    return path


@pytest.fixture
def nothing_is_small(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def shuffled(df):
    """What each shuffle by a key is dealt by."""
    return re.findall(r"Exchange hashpartitioning\((.*?), \d+\)", plan(df))


def test_parts_grow_with_the_lines(spark, folder, monkeypatch):
    assert adapter.parts(spark, folder) == adapter.LEAST_PARTS
    monkeypatch.setattr(adapter, "PART_BYTES", 64)
    few = adapter.parts(spark, folder)
    monkeypatch.setattr(adapter, "PART_BYTES", 16)
    assert few > adapter.LEAST_PARTS and adapter.parts(spark, folder) == 4 * few


def test_order_documents_shuffle_the_lines_once_as_they_are(spark, folder, nothing_is_small):
    docs = adapter.order_documents(spark, folder)
    assert len(shuffled(docs)) == 2  # the lines and the orders
    rows = docs.collect()
    assert len(rows) == 40
    whole = next(r for r in rows if r.src_file_path == "file:/matches/9.json")
    balls = [b for side in whole.innings for six in side.overs or () for b in six.deliveries]
    assert balls and [side.team for side in whole.innings] == ["NATION_9", "NATION_19"]


def test_sums_by_match_need_no_shuffle_of_their_own(spark, folder, nothing_is_small):
    sums = partials.over_sums(adapter.balls(spark, folder))
    assert all("match_id" in keys or "custkey" in keys for keys in shuffled(sums))
    assert len(shuffled(sums)) == 4  # lines, orders, and these with the customers
    stored = layers.over_sums(spark, folder)
    assert stored.agg(F.sum("balls_legal")).first()[0] == 39 * 6
    assert shuffled(partials.order_and_scores(stored)) == []
    assert all("match_id" not in keys for keys in shuffled(partials.batter_season(stored)))


def test_buckets_grow_with_the_lines(spark, folder, monkeypatch):
    monkeypatch.setattr(adapter, "PART_BYTES", 64)
    number = adapter.parts(spark, folder)
    balls = layers.bucketed(spark, folder, "grown_balls", catalog.dealt_balls, dealt=True)
    assert number > 8
    assert rollups.innings_scores(balls).where("match_id is not null").count() == 39
    assert f"SelectedBucketsCount: {number} out of {number}" in plan(rollups.innings_scores(balls))


def test_a_bucket_is_one_file_where_the_session_has_more_partitions(spark, folder, nothing_is_small):
    spark.conf.set("spark.sql.shuffle.partitions", 24)
    try:
        flawed = layers.bucketed(spark, folder, "grown_flawed", adapter.flawed_balls, dealt=True)
        matches = catalog.bucketed_matches(spark, folder)
        assert "SelectedBucketsCount: 24 out of 24" in plan(flawed.join(matches, "match_id"))
        for table in (flawed, matches):
            files = table.inputFiles()
            assert len({file.split("_")[-1] for file in files}) == len(files) > adapter.LEAST_PARTS
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 8)


def test_matches_are_dealt_before_anything_is_made_of_them(spark, folder, nothing_is_small, monkeypatch):
    monkeypatch.setattr(layers, "_STORED", {})
    stored, settled = [], layers.settled
    monkeypatch.setattr(layers, "settled", lambda df, name: stored.append(df) or settled(df, name))
    layers.silver_matches(spark, folder)
    dealt = re.findall(r"Exchange hashpartitioning\(cast\(o_orderkey.*?\n.*?Project \[(.*?)\]", plan(stored[0]))
    assert [re.findall(r"[a-z]_[a-z]+", columns) for columns in dealt] == [list(adapter.MATCH_SOURCE)]
    assert not any("match_id" in keys for keys in shuffled(stored[0]))  # they meet the sums in their buckets
    plain, dealt = (adapter.bronze_matches(spark, folder, dealt=d) for d in (False, True))
    assert plain.count() == dealt.count() == 40
    assert plain.exceptAll(dealt).isEmpty() and dealt.exceptAll(plain).isEmpty()


def test_weekly_documents_are_nested_in_many_parts_from_lines_stored_once(spark, folder, nothing_is_small, monkeypatch, tmp_path):
    monkeypatch.setattr(layers, "_STORED", {})
    monkeypatch.setattr(catalog, "settled", lambda df, name="table": pytest.fail(f"{name} is stored") if "innings" in df.columns else layers.settled(df, name))
    catalog.manifest_new_files(spark, folder)
    weekly = layers.weekly_documents(spark, folder)
    assert not any("lineitem" in file for file in weekly.inputFiles())
    assert not any("l_orderkey" in keys for keys in shuffled(weekly))
    assert weekly.rdd.getNumPartitions() == adapter.parts(spark, folder)
    plain = adapter.period_documents(spark, folder, 7)
    texts = lambda df: {r[0]: r[1] for r in df.select("k", F.to_json(F.struct("info", "innings"))).collect()}
    assert texts(weekly) == texts(plain) and len(texts(plain)) > 8
    assert weekly.where("k >= 226").count() == plain.where("k >= 226").count() > 0


def test_document_files_are_compressed_and_only_documents(spark, folder, tmp_path):
    weekly = adapter.period_documents(spark, folder, 7)
    documents.write_document_files(weekly.where("false"), f"{tmp_path}/files")
    path = documents.write_document_files(weekly, f"{tmp_path}/files")
    files = documents.list_files(spark, path, "*.txt.gz")
    assert files.count() == files.select("file_name").distinct().count() == weekly.count()
    assert documents.list_files(spark, path, "*.txt").count() == 0


def test_broken_texts_are_not_stored_a_second_time(spark, folder, tmp_path):
    weekly = adapter.period_documents(spark, folder, 7).where("k is not null")
    texts = catalog.write_broken(weekly, 2, f"{tmp_path}/files")
    assert "creaseline-texts" not in plan(texts)
    read = documents.read_documents(spark, f"{tmp_path}/files", "*.txt.gz", keep_malformed=True)
    written = weekly.select(F.count_if(F.col("k") % 2 == 0), F.count_if(F.col("k") % 2 != 0)).first()
    assert read.select(F.count_if(F.col(documents.CORRUPT).isNotNull()), F.count_if(F.col(documents.CORRUPT).isNull())).first() == written


def test_chain_stores_and_resolves_only_what_the_sums_need(spark, folder, monkeypatch):
    people = [(n, f"Supplier#{n:09d}", n) for n in (1, 2, 3)]  # the lines name 0 to 3
    spark.createDataFrame(people, "s_suppkey bigint, s_name string, s_nationkey int").write.parquet(f"{folder}/supplier.parquet")
    settled, stored = layers.settled, []
    monkeypatch.setattr(layers, "settled", lambda df, name="": stored.append((name, df)) or settled(df, name or "table"))
    sums = layers.chain_sums(spark, folder)
    silver = next(df for name, df in stored if name == "chain-silver")
    assert silver.columns == list(layers.SUMMED_COLUMNS)
    sides = next(df for _, df in stored if df.columns == ["batting_team", "bowling_team"])
    assert "Join" not in plan(sides)  # team names in use are found without the players
    names = [df for _, df in stored if df.columns == ["striker", "non_striker", "bowler"]]
    assert len(names) == 1
    assert sums.count() == sums.select(*partials.OVER_KEYS).distinct().count()
    totals = [F.sum(c) for c in ("runs_total", "balls_legal", "wickets", "outs")]
    legal = F.when((F.col("extra_wides") == 0) & (F.col("extra_noballs") == 0), 1).otherwise(0)
    out = F.col("wicket_fell") & (F.col("wicket_player_out") == F.col("striker"))
    found = silver.agg(F.sum("runs_total"), F.sum(legal), F.sum(F.col("wicket_fell").cast("int")), F.sum(F.when(out, 1).otherwise(0)))
    assert sums.agg(*totals).first() == found.first()
    assert {r.bowler_id for r in sums.select("bowler_id").distinct().collect()} == {None, "1", "2", "3"}
    assert sums.where("batting_team_id is null or bowling_team_id is null").count() == 0


def test_named_tables_deal_the_lines_once(spark, folder, monkeypatch):
    """Balls are made for the gold tables, the matches, the sample, the sums and the team names."""
    spark.createDataFrame([(n, f"Supplier#{n:09d}", n) for n in (1, 2, 3)], "s_suppkey bigint, s_name string, s_nationkey int").write.mode("ignore").parquet(f"{folder}/supplier.parquet")
    spark.createDataFrame([(n, f"NATION_{n}") for n in range(25)], "n_nationkey int, n_name string").write.mode("ignore").parquet(f"{folder}/nation.parquet")
    monkeypatch.setattr(layers, "_STORED", {})
    deal, dealt = adapter.dealt_lines, []
    monkeypatch.setattr(adapter, "dealt_lines", lambda *a: dealt.append(a) or deal(*a))
    sizes = catalog.named_tables(spark, folder)
    assert len(dealt) == 1
    assert not any("lineitem" in file for file in sizes.inputFiles())
    found = {r.table: r.rows for r in sizes.collect()}
    lines = layers.lines(spark, folder)
    for name in set(catalog.NAMED_TABLES) - {"silver.dim_player", "silver.dim_team"}:
        build = catalog.NAMED_TABLES[name]
        plain = build(spark, folder, None).drop("src_ingest_ts")
        assert found[name] == plain.count()
        assert plain.exceptAll(build(spark, folder, lines).drop("src_ingest_ts")).isEmpty(), name
    shared = layers.teams(spark, folder)
    monkeypatch.setattr(layers, "_STORED", {})
    alone = layers.teams(spark, folder)
    assert found["silver.dim_team"] == alone.count() and alone.exceptAll(shared).isEmpty()
