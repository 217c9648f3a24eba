"""Every catalogued query against its SQL counterpart, and the shape of its plan."""

import re
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as contract
import oracle
from clickweave.catalog import QUERIES

DATA = "/root/testdata/sf0.001"
STREAMS = [name for name in QUERIES if name.startswith("stream_")]
BATCH = [name for name in QUERIES if name not in STREAMS]

pytestmark = pytest.mark.skipif(not Path(DATA).exists(), reason="no test data")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW events AS FROM read_parquet('{DATA}/events.parquet')")
    return connection


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(row[i] for i in order) for row in rows), key=repr)


def test_every_query_has_a_counterpart():
    assert set(QUERIES) == set(oracle.statements())
    assert set(QUERIES) <= set(contract.queries()) and set(QUERIES) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_its_sql(spark, duck, name):
    found = contract.queries()[name](spark, DATA)
    wanted = duck.execute(contract.oracle_sql()[name])
    columns = [d[0] for d in wanted.description]
    assert sorted(columns) == sorted(found.columns)
    assert _rows(found.columns, found.collect()) == _rows(columns, wanted.fetchall())


@pytest.mark.parametrize("name", BATCH)
def test_plan_scales(spark, name):
    plan = contract.queries()[name](spark, DATA)._jdf.queryExecution().executedPlan().toString()
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python"):
        assert node not in plan
    # No window over all rows in one task.
    single = re.findall(r"Window [^\n]*\n[^\n]*Sort[^\n]*\n[^\n]*Exchange SinglePartition", plan)
    assert not single


def test_entry_runs(spark):
    assert contract.entry(spark).count() > 0
