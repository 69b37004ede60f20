"""The texts of documents, made in pieces, are those of whole documents."""

import datetime

import pytest
from pyspark.sql import functions as F

from creaseline.plans import adapter, catalog, layers
from creaseline.sources import documents


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Weeks with many equal lines, without lines, without date, and lines without quantity or supplier."""
    path = str(tmp_path_factory.mktemp("weeks"))
    day = datetime.datetime(1992, 1, 1)
    orders = [(n, day + datetime.timedelta(days=2 * n) if n % 17 else None) for n in range(80)]
    lines = [
        (n, i % 3, None if i == 1 else n % 4, i % 4, None if i == 2 else float(i), 0.04, 0.01 * (i % 9), "RNA"[i % 3], None if i == 4 else "FO"[i % 2])
        for n in range(70)
        for i in range(30 if n % 9 else 0)
        for _ in range(3 if i == 9 else 1)
    ]
    spark.createDataFrame(orders, "o_orderkey bigint, o_orderdate timestamp_ntz").write.parquet(f"{path}/orders.parquet")
    schema = "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_discount double, l_tax double, l_returnflag string, l_linestatus string"
    spark.createDataFrame(lines, schema).write.parquet(f"{path}/lineitem.parquet")
    return path


def files(spark, path):
    rows = spark.read.text(path, wholetext=True).select(catalog.week_of(F.col("_metadata.file_path")).alias("k"), "value").collect()
    assert len({r.k for r in rows}) == len(rows)
    return {r.k: r.value for r in rows}


def texts(spark, folder, where="true", change=lambda docs: docs):
    body = F.to_json(F.struct("info", "innings"), {"pretty": "true"})
    rows = change(layers.weekly_documents(spark, folder).where(where)).select("k", body.alias("text")).collect()
    return {"" if r.k is None else str(r.k): r.text + "\n" for r in rows}


def test_files_written_in_pieces_are_those_of_whole_documents(spark, folder, tmp_path):
    whole = texts(spark, folder)
    written = files(spark, documents.write_document_files(layers.weekly_texts(spark, folder), f"{tmp_path}/all", "k"))
    assert written == whole and len(whole) > 20 and "" in whole
    assert any('"deliveries" : [ ]' in text for text in whole.values()) and any('"innings"' not in text for text in whole.values())
    change = lambda docs: docs.where("k % 3 = 2").union(adapter.changed_documents(docs.where("k % 3 = 1")))
    changed = layers.weekly_texts(spark, folder, "k % 3 <> 0", change)
    assert files(spark, documents.write_document_files(changed, f"{tmp_path}/changed", "k")) == texts(spark, folder, "k % 3 <> 0", change)
    cut = catalog.write_broken(layers.weekly_texts(spark, folder), 2, f"{tmp_path}/cut")
    assert files(spark, f"{tmp_path}/cut") == {k: text[:-3] + "\n" if k and int(k) % 2 == 0 else text for k, text in whole.items()}
    assert cut.columns == ["k", "n", "value"]


def test_no_row_holds_more_than_a_ball_or_what_is_between(spark, folder):
    pieces = layers.weekly_texts(spark, folder)
    longest = pieces.agg(F.max(F.length("value"))).first()[0]
    assert longest < 1600 < max(map(len, texts(spark, folder).values())) / 10
    assert pieces.where("last").count() == pieces.select("k").distinct().count()
    plan = pieces._jdf.queryExecution().executedPlan().toString()
    assert "collect_list" not in plan
