"""Joins with many keys that shuffle few rows, and the stream that needs them."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from basketry.operators import upsert
from basketry.registry import queries
from basketry.session import stash
from tests.conftest import rows

KINDS = {"bigint": "id", "text": "md5(string(id))", "binary": "unhex(md5(string(id)))", "double": "double(id)"}


@pytest.mark.parametrize("few", [0, 100])
@pytest.mark.parametrize("kind", KINDS)
def test_joins_with_keys_equal_plain_joins(spark, monkeypatch, few, kind):
    monkeypatch.setattr(upsert, "FEW_UPDATES", few)
    key = F.when(F.col("id") % 10 != 7, F.expr(KINDS[kind])).alias("k")
    left = spark.range(400).select(key, "id")
    keys = stash(spark.range(390, 420).unionByName(spark.range(395, 400)).select(key), "keys")
    for ours, how in ((upsert.rows_of_keys, "left_semi"), (upsert.rows_without_keys, "left_anti")):
        assert rows(ours(left, keys, "k").select("id")) == rows(left.join(keys, "k", how).select("id"))
        assert ours(left, keys.limit(0), "k").count() == (400 if how == "left_anti" else 0)


def test_keys_of_another_type_filter_nothing(spark, monkeypatch):
    monkeypatch.setattr(upsert, "FEW_UPDATES", 0)
    keys = spark.range(3, 6).select(F.col("id").cast("int").alias("id"))
    assert [r[0] for r in rows(upsert.rows_of_keys(spark.range(10), keys, "id"))] == [3, 4, 5]


def test_few_rows_pass_the_filter(spark):
    keys = spark.range(0, 100_000, 100)
    assert 1000 <= upsert.near_keys(spark.range(100_000), keys, "id").count() < 1100


def star(spark, folder):
    day = dt.datetime(2001, 1, 1)
    days = [day + dt.timedelta(days=3 * i) for i in range(80)]
    lines = [
        (o, o % 7, 1, n, float(n + 1), 10.25 * (n + 1), 0.05, "RNA"[(o + n) % 3], "FO"[n % 2], days[o] + dt.timedelta(days=20 * n))
        for o in range(80)
        for n in range(4)
    ]
    given = {
        "nation": ([(1, "PERU")], "n_nationkey int, n_name string"),
        "customer": ([(i, f"c{i}", 1, "BUILDING") for i in range(5)], "c_custkey long, c_name string, c_nationkey int, c_mktsegment string"),
        "part": ([(i, f"p{i}", "T", 3.5) for i in range(6)], "p_partkey long, p_name string, p_type string, p_retailprice double"),
        "orders": ([(o, o % 5, "FOP"[o % 3], 99.5, days[o]) for o in range(80)], "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp"),
        "lineitem": (lines, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_returnflag string, l_linestatus string, l_shipdate timestamp"),
    }
    for name, (data, schema) in given.items():
        spark.createDataFrame(data, schema).repartition(4).write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


def test_early_returns_arrive_in_two_batches_written_by_many_tasks(spark, monkeypatch, tmp_path):
    folder, runs, written = star(spark, tmp_path), [], []

    def start(*args):
        runs.append(start_stream(*args))
        return runs[-1]

    def write(df, path, **more):
        written.append((df._jdf.queryExecution().executedPlan().toString(), write_table(df, path, **more)))
        return written[-1][1]

    start_stream, write_table = queries.refresh_fct_orders_stream, queries.write_table
    monkeypatch.setattr(queries, "refresh_fct_orders_stream", start)
    monkeypatch.setattr(queries, "write_table", write)
    monkeypatch.setattr(upsert, "FEW_UPDATES", 0)
    got = rows(queries.QUERIES["fct_orders_stream_early_returns"](spark, folder))
    assert len(got) == 80 and got == rows(queries.QUERIES["fct_orders_incremental"](spark, folder))
    assert [p["numInputRows"] > 0 for p in runs[0].recentProgress] == [True, True]
    for text, _ in written:  # ids are read as they were stored, by several tasks
        assert "md5" not in text and "Coalesce 1\n" not in text
    assert len(written[1][1].inputFiles()) > 2
