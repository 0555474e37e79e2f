"""The order x product rollup, its shuffles, and a first load from stored rows."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketry.functions import match_key
from basketry.operators import upsert
from basketry.plans import metrics, quality, refresh
from basketry.plans.warehouse import Warehouse
from basketry.session import stash
from tests.conftest import rows
from tests.shop import raw


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_match_key_is_short_for_md5_and_tells_all_keys_apart(spark):
    digest = "0123456789abcdef" * 2
    texts = [digest, digest.upper(), digest + "\n", digest[:-1], bytes.fromhex(digest).decode("latin-1"), "", " ", None]
    df = spark.createDataFrame([(t,) for t in texts], "k string")
    keys = [r[0] for r in df.select(match_key(F.col("k"), T.StringType())).collect()]
    assert len(keys[0]) == 16 and keys[-1] is None
    assert len({bytes(k) for k in keys if k is not None}) == len(texts) - 1
    number = spark.range(1).select(match_key(F.col("id"), T.LongType()).alias("k"))
    assert number.dtypes == [("k", "bigint")]


def test_orders_are_summed_where_the_rollup_puts_them(spark):
    s = Warehouse(raw(spark)).staged
    per_order = metrics.order_product_rollup(s.order_items, s.returns).groupBy("order_id").count()
    text = plan(per_order)
    above = text.split("Union")[0]  # the shuffle of lines and returned lines is the only one
    assert above.count("Exchange") == 1 and "REPARTITION_BY_COL" in above


@pytest.mark.parametrize("null", [False, True])
def test_a_hot_order_is_spread_by_product(spark, monkeypatch, null):
    s = Warehouse(raw(spark)).staged
    items = s.order_items.withColumn("order_id", F.when(F.col("order_id") != 103, F.col("order_id"))) if null else s.order_items
    usual = metrics.order_product_rollup(items, s.returns)
    monkeypatch.setattr(metrics, "HOT_LINES", 1)
    spread = metrics.order_product_rollup(items, s.returns)
    assert "REPARTITION_BY_COL" in plan(usual) and "REPARTITION_BY_COL" not in plan(spread)
    assert rows(usual) == rows(spread)


def test_repeated_and_null_line_ids(spark):
    s = Warehouse(raw(spark)).staged
    items = s.order_items.where("order_item_id = 1001").unionByName(s.order_items.where("order_item_id = 1001"))
    items = items.unionByName(items.withColumn("order_item_id", F.lit(None).cast("bigint")))
    returns = s.returns.unionByName(s.returns.withColumn("order_item_id", F.lit(None).cast("bigint")))
    (row,) = metrics.order_product_rollup(items, returns).collect()
    assert (row.product_lines, row.product_quantity, row.return_count, row.units_returned) == (4, 8, 4, 8)
    assert row.refund_amount == 260


def test_returns_given_apart_take_the_place_of_those_stored(spark):
    wh = Warehouse(raw(spark))
    s = wh.staged
    some = s.returns.where("return_id = 5001")
    apart = metrics.order_metrics(
        s.orders, s.order_items, some, wh.order_products, metrics.order_returns(s.order_items, some)
    )
    assert rows(apart) == rows(metrics.order_metrics(s.orders, s.order_items, some))


def test_first_load_from_stored_rows(spark, tmp_path):
    wh = Warehouse(raw(spark))
    stored = {"sold": wh.order_products, "metrics": wh.order_metrics}
    loads = [{}, {"sold": wh.order_products}, stored]
    found = [
        rows(refresh.load_facts_until(str(tmp_path / str(i)), wh.staged, wh.dim_customers, "2024-02-11", **more))
        for i, more in enumerate(loads)
    ]
    assert len(found[0]) == 4 and found[0] == found[1] == found[2]


def test_checked_keys_are_stored_short(spark):
    ids = spark.range(5).select(F.md5(F.col("id").cast("string")).alias("k"), "id")
    tables = {"a": ids, "b": ids.where("id < 3")}
    rules = {"a": [quality.Unique(["k"]), quality.Reference("k", "b", "k")], "b": []}
    passes = quality._Passes(tables, rules, {})
    assert dict(passes.keys["a"].dtypes) == {"k": "binary"}
    assert {(r.check_name, r.violations) for r in quality.run_checks(tables, rules).collect()} == {
        ("unique", 0), ("relationships", 2),
    }
    tables["b"] = spark.range(3).select(F.col("id").alias("k"))
    tables["a"] = spark.range(5).select(F.col("id").cast("string").alias("k"))
    assert [r.violations for r in quality.run_checks(tables, rules).collect()] == [0, 2]


def test_stored_frames_are_compressed_well(spark):
    where = stash(spark.range(3), "some").inputFiles()
    assert all(".zstd." in name for name in where)


def test_good_records_keep_no_copy(spark):
    from basketry.sources import load

    text = {c: "1" for c in load.RAW_COLUMNS["orders"]} | {"order_date": "2024-01-01", "ingested_at": "2024-01-01"}
    bad = text | {"order_date": "never"}
    names = [*text, load._BAD, "_file"]
    given = spark.createDataFrame([(*text.values(), None, "f"), (*bad.values(), None, "f")], ", ".join(f"{n} string" for n in names))
    found = load._checked(given, "orders", load.RAW_TYPES["orders"]).select("_record").collect()
    assert [r[0] is None for r in found] == [True, False]


@pytest.mark.parametrize("apart", [False, True])
def test_returns_are_matched_once(spark, tmp_path, apart):
    wh = Warehouse(raw(spark))
    late = "return_date > '2024-02-20' and order_item_id = 1001"
    known = wh.match_returns(F.expr(late) if apart else None)
    stored = spark.read.parquet(*known.inputFiles())
    assert ("line_key" in stored.columns) == (not apart)
    assert rows(wh.order_products) == rows(Warehouse(raw(spark)).order_products)
    some = wh.staged.replace(returns=wh.staged.returns.where(late if apart else "order_item_id = 1001"))
    known = metrics.some_returned_lines(known) if apart else known.where("line_key = 1001")
    loads = [{}, {"sold": wh.order_products, "returned": known}]
    found = [
        rows(refresh.load_facts_until(str(tmp_path / str(i)), some, wh.dim_customers, "2024-02-11", **more))
        for i, more in enumerate(loads)
    ]
    assert found[0] == found[1]


def test_waiting_returns_are_found_by_short_keys(spark):
    ids = [F.md5(F.col("id").cast("string")).alias("order_item_id"), F.col("id").alias("order_id")]
    items = spark.range(5).select(*ids)
    returns = spark.range(3, 7).select(ids[0]).unionByName(spark.createDataFrame([(None,), ("x",)], "order_item_id string"))
    orders, unmatched = refresh.match_returns(returns, items)
    assert [r[0] for r in rows(orders)] == [3, 4]
    assert rows(unmatched) == rows(spark.range(5, 7).select(ids[0]).unionByName(returns.where("order_item_id = 'x'")))
    assert "binary" in dict(orders.sparkSession.read.parquet(*orders.inputFiles()).dtypes).values()


def test_stored_order_metrics_leave_out_the_md5(spark):
    wh = Warehouse(raw(spark))
    assert "order_surrogate_key" not in spark.read.parquet(*wh.order_metrics.inputFiles()).columns
    assert wh.order_metrics.columns == wh.fresh_order_metrics().columns
    assert rows(wh.order_metrics) == rows(wh.fresh_order_metrics())


@pytest.mark.parametrize("few", [0, 100])
def test_lines_are_not_shuffled_for_a_usual_batch(spark, monkeypatch, few):
    s, plans = Warehouse(raw(spark)).staged, {}

    def seen(df, label):
        plans[label] = plan(df)
        return stash(df, label)

    monkeypatch.setattr(refresh, "stash", seen)
    monkeypatch.setattr(upsert, "FEW_UPDATES", few)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        orders, unmatched = refresh.match_returns(s.returns, s.order_items)
        assert [r[0] for r in rows(orders)] == [100, 104] and unmatched.count() == 0
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert ("BroadcastHashJoin" in plans["returned-lines"]) == (few > 0)
