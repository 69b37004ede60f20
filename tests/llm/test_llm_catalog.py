"""Registered queries against their SQL, and the pipeline against its stages' plain laws."""

from pathlib import Path

import pytest

import corpus_pipeline
from compare import connect, differences
from creaseline.llm import catalog
from test_llm_jaccard import plain_components, plain_set
from test_llm_mixing import plain_targets

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="driver tables not present")


@pytest.fixture(scope="module")
def duck():
    con = connect(FOLDER)
    yield con
    con.close()


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_against_sql(spark, duck, name):
    assert differences(catalog.QUERIES[name](spark, FOLDER), duck, catalog.ORACLES[name]) == []


def test_pipeline(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    items = [r.text for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    steps = {}
    for name, stage in corpus_pipeline.STAGES[:4]:
        before = docs
        docs = stage(spark, docs, FOLDER).cache()
        assert docs.columns == before.columns
        steps[name] = ({r.doc_id: r.text for r in before.collect()}, docs.collect())
    before, after = steps["quality classifier"]
    kept = {r.doc_id for r in after}
    known = [k for k in before if k in labels]
    assert sum((k in kept) == bool(labels[k]) for k in known) >= 0.9 * len(known)

    before, after = steps["n-gram Jaccard join"]
    groups = plain_components(list(before.items()))
    assert sorted(r.doc_id for r in after) == sorted(k for k, (_, c) in groups.items() if c == k)

    before, after = steps["benchmark decontamination"]
    tests = [plain_set(t) for t in items]
    leaks = {k for k, t in before.items() for s in tests if 4 * len(s & plain_set(t)) >= 3 * len(s)}
    assert {r.doc_id for r in after} == set(before) - leaks

    before, after = steps["mixing sources"]
    sizes, mixed = {}, {}
    sources = {r.doc_id: r.source for r in steps["benchmark decontamination"][1]}
    for k, t in before.items():
        sizes[sources[k]] = sizes.get(sources[k], 0) + len(t.split())
    for r in after:
        mixed[r.source] = mixed.get(r.source, 0) + len(r.text.split())
    for source, target in plain_targets(sizes).items():
        assert abs(mixed.get(source, 0) - target) <= 34

    final = corpus_pipeline.STAGES[4][1](spark, docs, FOLDER).collect()
    assert len(final) == len(after)
    slots = {}
    for r in final:
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_pipeline_runs_whole(spark):
    assert corpus_pipeline.run(spark, FOLDER).count() > 0
