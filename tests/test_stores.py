"""Layer tables on disk."""

import os

import pytest
from pyspark.sql import functions as F

from creaseline.sources import schemas, tables, workspace


@pytest.fixture()
def seasons(rows):
    return rows("k int, season string", *((n, "2009" if n % 3 else "2007") for n in range(30)))


def test_partitioned_table_keeps_season_text(spark, seasons, tmp_path):
    path = tables.write_table(seasons, f"{tmp_path}/t", partition_by=["season"])
    back = tables.read_table(spark, path, schema=seasons.schema)
    assert dict(back.dtypes)["season"] == "string"
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, seasons.collect()))


def test_touched_partitions_only(spark, seasons, tmp_path):
    path = tables.write_table(seasons, f"{tmp_path}/t", partition_by=["season"])
    tables.write_table(seasons.where("season = '2007'").limit(1), path, partition_by=["season"], touched_partitions_only=True)
    counts = {r.season: r["count"] for r in tables.read_table(spark, path, schema=seasons.schema).groupBy("season").count().collect()}
    assert counts == {"2007": 1, "2009": 20}


def test_replace_table_from_itself(spark, seasons, tmp_path):
    path = f"{tmp_path}/t"
    tables.replace_table(seasons, path, partition_by=["season"])
    for added in ("a", "b"):
        stored = tables.read_table(spark, path)
        tables.replace_table(stored.withColumn(added, F.col("k") + 1), path, partition_by=["season"])
    back = tables.read_table(spark, path)
    assert back.count() == 30 and back.where("a = k + 1 and b = k + 1").count() == 30
    assert os.listdir(tmp_path) == ["t"]


def test_failed_replacement_keeps_the_table(spark, seasons, tmp_path):
    path = tables.write_table(seasons, f"{tmp_path}/t")
    broken = tables.read_table(spark, path).withColumn("x", F.raise_error(F.lit("stop")).cast("string"))
    with pytest.raises(Exception, match="stop"):
        tables.replace_table(broken, path)
    assert tables.read_table(spark, path).count() == 30


def test_missing_tables(spark, seasons, tmp_path):
    assert tables.read_or_none(spark, f"{tmp_path}/none") is None
    empty = tables.read_or_empty(spark, f"{tmp_path}/none", schemas.DIM_TEAM)
    assert empty.count() == 0 and empty.columns == schemas.DIM_TEAM.fieldNames()
    path = tables.write_table(seasons, f"{tmp_path}/t")
    assert tables.read_or_empty(spark, path, seasons.schema).count() == 30


def test_export_and_size(spark, seasons, tmp_path):
    path = tables.export_csv(seasons, f"{tmp_path}/csv", 3, "season", "k")
    back = spark.read.option("header", True).csv(path)
    assert [(r.k, r.season) for r in back.orderBy(F.col("k").cast("int")).collect()] == [("0", "2007"), ("3", "2007"), ("6", "2007")]
    assert tuple(tables.table_size(seasons).first()) == (30, 2)


def test_files_per_layout(spark, tmp_path):
    found = tables.files_per_layout(spark.range(3000), f"{tmp_path}/l", (1, 4, 16)).collect()
    assert sorted(map(tuple, found)) == [(1, 1, 3000), (4, 4, 3000), (16, 16, 3000)]


def test_workspace(spark, seasons):
    folder = workspace.shared_folder(spark)
    assert folder == spark.conf.get("spark.checkpoint.dir")
    assert workspace.fresh_path(spark, "a") != workspace.fresh_path(spark, "a")
    assert workspace.settled(seasons).count() == 30
