"""Every registered query against its SQL counterpart on the driver's smallest tables."""

import re
from pathlib import Path

import pytest

import __spark_entry__ as contract
from compare import connect, differences
from creaseline.plans.catalog import QUERIES
from creaseline.plans.oracles import ORACLES

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="driver tables not present")


@pytest.fixture(scope="module")
def duck():
    con = connect(FOLDER)
    yield con
    con.close()


def test_every_query_has_a_counterpart():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(contract.queries()) and set(ORACLES) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = contract.queries()[name](spark, FOLDER)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not re.search("CartesianProduct|BroadcastNestedLoopJoin|BatchEvalPython|Window", plan)
    assert differences(df, duck, contract.oracle_sql()[name]) == []


def test_entry(spark):
    assert contract.entry(spark).count() > 0


def test_core_has_no_single_machine_steps():
    """Nothing is gathered on the driver or forced into one task.

    The exceptions are a file scan's paths, as many as the caller asks for or one, and the
    earlier ingest runs whose files have changed.
    """
    root = Path(contract.__file__).parent / "creaseline"
    banned = re.compile(r"toPandas|localCheckpoint|crossJoin|repartition\(1\)|coalesce\(1\)|\.rdd\.map|\.collect\(\)")
    hits = [
        (path.name, line.strip())
        for path in root.rglob("*.py")
        if "llm" not in path.relative_to(root).parts
        for line in path.read_text(encoding="utf8").splitlines()
        if banned.search(line)
    ]
    assert [name for name, _ in hits] == ["documents.py", "ingest.py"]
