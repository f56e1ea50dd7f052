"""Every registered query against its SQL, and the shape of the plans."""

import re
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as contract
from catalog import items, prompting, publishing, scoring

DATA = Path("/root/testdata/sf0.001")
TABLES = [p.stem for p in sorted(DATA.glob("*.parquet"))]
OWN = {name for module in (scoring, items, prompting, publishing) for name in module.QUERIES}
QUERIES = {name: run for name, run in contract.queries().items() if name in OWN}
SQL = {name: sql for name, sql in contract.oracle_sql().items() if name in OWN}

pytestmark = pytest.mark.skipif(not TABLES, reason="no test tables here")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{DATA}/{name}.parquet'")
    return con


def test_every_query_has_sql():
    assert set(SQL) == set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, duck, name):
    df = QUERIES[name](spark, str(DATA))
    columns = sorted(df.columns)
    got = sorted(repr(tuple(r)) for r in df.select(*[f"`{c}`" for c in columns]).collect())
    result = duck.execute(SQL[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    places = [names.index(c) for c in columns]
    assert got == sorted(repr(tuple(r[i] for i in places)) for r in result.fetchall())
    assert got


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["eval_table", "prompt_for_model", "bench_index", "leaderboard", "upsert_answers_model_bench"])
def test_no_cross_joins_and_no_window_over_facts(spark, name):
    plan = plan_of(QUERIES[name](spark, str(DATA)))
    assert not re.search("NestedLoop|Cartesian", plan)
    assert not re.search(r"\bWindow\b", plan)


def test_text_is_not_read_for_keys(spark):
    plan = plan_of(QUERIES["parse_yes_no"](spark, str(DATA)))
    assert all("text" not in schema for schema in re.findall(r"ReadSchema: (\S+)", plan))
