"""Every registered query against its SQL on the small test tables, and the shape of plans."""

import re
from pathlib import Path

import duckdb
import pytest

from basketry.registry.oracle import ORACLE_SQL
from basketry.registry.queries import QUERIES

FOLDER = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not FOLDER.exists(), reason="test tables are not there")
TYPES = {
    "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE",
    "boolean": "BOOLEAN",
}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in FOLDER.glob("*.parquet"):
        con.sql(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    yield con
    con.close()


def in_order(data):
    return sorted(data, key=lambda row: [(x is None, str(x)) for x in row])


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE_SQL)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, duck, name):
    got = QUERIES[name](spark, str(FOLDER))
    want = duck.sql(ORACLE_SQL[name])
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)
    kinds = dict(zip(want.columns, map(str, want.types)))
    assert {c: TYPES[t] for c, t in got.dtypes} == kinds
    found = [tuple(r) for r in got.select(*columns).collect()]
    assert in_order(found) == in_order(want.select(*columns).fetchall())


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def scanned(text, table):
    """Columns read from a table, over all of its scans."""
    scans = re.findall(r"FileScan parquet \[([^\]]*)\][^\n]*" + table, text)
    return {re.sub(r"#\d+L?", "", c) for s in scans for c in s.split(",")}


def test_scans_read_only_what_is_needed(spark):
    text = plan(QUERIES["primary_product"](spark, str(FOLDER)))
    assert scanned(text, "lineitem") == {
        "l_orderkey", "l_partkey", "l_quantity", "l_extendedprice",
    }
    assert scanned(text, "part.parquet") == {"p_partkey", "p_name", "p_type"}
    returns = plan(QUERIES["stg_returns"](spark, str(FOLDER)))
    assert "EqualTo(l_returnflag,R)" in returns


@pytest.mark.parametrize(
    "name", ["order_metrics", "primary_product", "fct_orders", "product_performance", "top_products"]
)
def test_plans_have_no_cross_join_and_no_python(spark, name):
    text = plan(QUERIES[name](spark, str(FOLDER)))
    for node in ("CartesianProduct", "NestedLoopJoin", "Python", "Pandas"):
        assert node not in text


def test_top_rows_are_limited_before_the_shuffle(spark):
    text = plan(QUERIES["primary_product_top_n"](spark, str(FOLDER)))
    assert text.count("WindowGroupLimit") == 2


@pytest.mark.parametrize("name", ["order_metrics", "primary_product", "category_mix", "fct_orders"])
def test_order_rollups_use_hash_aggregates(spark, name):
    assert "SortAggregate" not in plan(QUERIES[name](spark, str(FOLDER)))
