"""Every registered query against its SQL in DuckDB, and what its plan must not hold."""

import datetime as dt
import decimal
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from builders import plan_of
from gazette import workload

DATA = Path("/root/testdata/sf0.001")
TABLES = [p.stem for p in DATA.glob("*.parquet")]
# What is registered beside these has tests of its own.
NAMES = set(workload.QUERIES)
QUERIES = {n: q for n, q in entry.queries().items() if n in NAMES}
ORACLES = {n: q for n, q in entry.oracle_sql().items() if n in NAMES}

TWO_CALLS = {"enrich_articles", "enrich_within_deadlines", "ask_articles"}

pytestmark = pytest.mark.skipif(not TABLES, reason="test tables are not there")


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{DATA}/{name}.parquet'")
    return connection


def plain(value):
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, float):
        return round(value, 6)
    if isinstance(value, (dt.date, dt.datetime)):
        return str(value)
    return value


def table(columns, rows):
    order = sorted(columns)
    return order, sorted(
        ([plain(row[columns.index(c)]) for c in order] for row in rows), key=repr
    )


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    df = QUERIES[name](spark, str(DATA))
    plan = plan_of(df)
    for operator in ("CartesianProduct", "BatchEvalPython"):
        assert operator not in plan, f"{operator} in {name}"
    # An enrichment calls its model twice at most, a search embeds and measures.
    assert plan.count("ArrowEvalPython [") <= (2 if name in TWO_CALLS else 1)
    mine = table(df.columns, [tuple(r) for r in df.collect()])
    relation = con.sql(ORACLES[name])
    assert mine == table(relation.columns, relation.fetchall())


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLES)


def test_entry(spark):
    rows = entry.entry(spark).collect()
    assert {r.topic for r in rows} == {"tech-news", "finance-news", "world-news"}


def test_known_result(spark):
    """Counts worked out independently of this code."""
    larger = "/root/testdata/sf0.01"
    rows = QUERIES["route_articles"](spark, larger).collect()
    assert {r.topic: r.n for r in rows} == {
        "finance-news": 181, "tech-news": 84, "world-news": 263,
    }
