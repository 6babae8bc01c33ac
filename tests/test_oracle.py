"""Every registered query against DuckDB on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as entry
from support import plan_of

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
# Queries of texts have tests of their own, beside their operators.
QUERIES = {name: q for name, q in entry.queries().items() if name not in entry.LLM_QUERIES}
ORACLE = {name: sql for name, sql in entry.oracle_sql().items() if name not in entry.LLM_QUERIES}


@pytest.fixture(scope="module")
def duck(sf_dir):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return connection


def table_rows(table, columns):
    return sorted(map(repr, zip(*[table[c].to_pylist() for c in columns])))


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_sql(spark, duck, sf_dir, name):
    ours = QUERIES[name](spark, sf_dir).toArrow()
    theirs = duck.sql(ORACLE[name]).to_arrow_table()
    columns = sorted(ours.column_names)
    assert columns == sorted(theirs.column_names)
    assert table_rows(ours, columns) == table_rows(theirs, columns)


def test_entry_has_rows(spark):
    assert entry.entry(spark).limit(1).count() == 1


# Reads of tables, and shuffles and broadcasts, that the first plan of a query has at most.
PLANS = {
    "rolling_health_score": (3, 4),
    "rolling_30d_score": (1, 2),
    "running_sum": (1, 2),
    "dim_user_scd2": (1, 2),
    "lead_valid_to": (1, 2),
}


@pytest.mark.parametrize("name", PLANS)
def test_plans_read_and_shuffle_little(spark, sf_dir, name):
    plan = plan_of(QUERIES[name](spark, sf_dir))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "Exchange SinglePartition"):
        assert bad not in plan
    scans, exchanges = PLANS[name]
    assert plan.count("FileScan parquet") <= scans
    assert plan.count("Exchange ") <= exchanges
