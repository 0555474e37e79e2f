"""Upsert, partition rewrite, fact refresh, history and streaming."""

import pytest
from pyspark.sql import functions as F

from basketry.operators.history import scd2_from_snapshots, scd2_merge, scd2_start
from basketry.operators.upsert import reprocess_window, stored_table, upsert, write_incremental
from basketry.plans.refresh import load_facts_until, orders_of_returns, refresh_fct_orders
from basketry.plans.warehouse import Warehouse
from basketry.session import fresh_path
from basketry.streaming.jobs import event_stream, refresh_fct_orders_stream
from basketry.streaming.totals import daily_revenue, daily_revenue_stream
from tests import shop
from tests.conftest import day, rows

KV = "id int, d date, v string"


def frame(spark, *data):
    return spark.createDataFrame([(i, day(d) if d else None, v) for i, d, v in data], KV)


def test_upsert_replaces_inserts_and_is_idempotent(spark):
    target = frame(spark, (1, "2024-01-01", "a"), (2, "2024-01-02", "b"))
    updates = frame(spark, (2, "2024-01-02", "B"), (3, "2024-01-03", "c"))
    once = upsert(target, updates, ["id"])
    assert [r[2] for r in rows(once)] == ["a", "B", "c"]
    assert rows(upsert(once, updates, ["id"])) == rows(once)


def test_reprocess_window_is_inclusive_and_full_on_empty_target(spark):
    source = frame(spark, (1, "2024-01-01", ""), (2, "2024-01-06", ""), (3, "2024-01-07", ""))
    target = frame(spark, (9, "2024-01-20", ""))
    assert [r[0] for r in rows(reprocess_window(source, target, "d", 14))] == [2, 3]
    assert reprocess_window(source, target.limit(0), "d").count() == 3
    assert reprocess_window(source, None, "d").count() == 3


def table(spark, path):
    return rows(spark.read.parquet(path).select("id", "d", "v"))


def test_write_incremental_moves_rows_between_months(spark):
    path = fresh_path(spark, "kv")
    assert stored_table(spark, path) is None
    first = frame(
        spark, (1, "2024-01-05", "a"), (2, "2024-02-05", "b"), (3, "2024-03-05", "c"),
        (4, None, "n"),
    )
    write_incremental(first, path, ["id"], "d", month="m")
    # 2 is the only row of February and moves away; 1 changes in place; 5 is new
    second = frame(
        spark, (2, "2024-01-09", "B"), (1, "2024-01-05", "A"), (5, "2024-04-01", "e"),
        (4, "2024-03-01", "N"),
    )
    for _ in range(2):  # a replay changes nothing
        write_incremental(second, path, ["id"], "d", month="m")
        assert table(spark, path) == [
            (1, day("2024-01-05"), "A"), (2, day("2024-01-09"), "B"),
            (3, day("2024-03-05"), "c"), (4, day("2024-03-01"), "N"),
            (5, day("2024-04-01"), "e"),
        ]


def test_untouched_months_keep_their_files(spark):
    path = fresh_path(spark, "kv")
    write_incremental(
        frame(spark, (1, "2024-01-05", "a"), (2, "2024-02-05", "b")), path, ["id"], "d", month="m"
    )
    before = set(spark.read.parquet(path).where("id = 1").inputFiles())
    january = {f for f in before if "2024-01-01" in f}
    write_incremental(frame(spark, (2, "2024-02-06", "B")), path, ["id"], "d", month="m")
    after = set(spark.read.parquet(path).inputFiles())
    assert january and january <= after and not (before - january) & after


@pytest.fixture
def wh(spark):
    return Warehouse(shop.raw(spark))


def order_level(df):
    return rows(df.select("order_id", "status", "net_sales", "return_count", "primary_product_id"))


def test_incremental_equals_full_rebuild(spark, wh):
    path = fresh_path(spark, "facts")
    load_facts_until(path, wh.staged, wh.dim_customers, "2024-02-11")
    assert spark.read.parquet(path).count() == 4
    refresh_fct_orders(path, wh.staged, wh.dim_customers)
    assert order_level(spark.read.parquet(path)) == order_level(wh.fct_orders)


def test_first_refresh_is_a_full_load(spark, wh):
    path = fresh_path(spark, "facts")
    refresh_fct_orders(path, wh.staged, wh.dim_customers)
    assert order_level(spark.read.parquet(path)) == order_level(wh.fct_orders)


def without_returns(s):
    return s.replace(returns=s.returns.limit(0))


def test_late_returns_need_their_order_ids(spark, wh):
    """Order 100 is older than the window when its returns arrive."""
    path = fresh_path(spark, "facts")
    refresh_fct_orders(path, without_returns(wh.staged), wh.dim_customers)
    refresh_fct_orders(path, wh.staged, wh.dim_customers)
    kept = {r.order_id: r.return_count for r in spark.read.parquet(path).collect()}
    assert (kept[100], kept[104]) == (0, 1)
    ids = orders_of_returns(wh.staged.returns, wh.staged.order_items)
    refresh_fct_orders(path, wh.staged, wh.dim_customers, changed_order_ids=ids)
    assert order_level(spark.read.parquet(path)) == order_level(wh.fct_orders)


def test_stream_of_returns_refreshes_facts(spark, wh):
    path, inbox, state = (fresh_path(spark, n) for n in ("facts", "inbox", "state"))
    refresh_fct_orders(path, without_returns(wh.staged), wh.dim_customers)
    wh.staged.returns.write.parquet(inbox)

    def drain():
        arriving = spark.readStream.schema(wh.staged.returns.schema).parquet(inbox)
        run = refresh_fct_orders_stream(arriving, path, state, wh.staged, wh.dim_customers)
        run.awaitTermination()

    drain()
    assert order_level(spark.read.parquet(path)) == order_level(wh.fct_orders)
    drain()  # nothing new
    assert order_level(spark.read.parquet(path)) == order_level(wh.fct_orders)


def test_stream_of_orders_rebuilds_a_corrected_old_order(spark, wh):
    """Order 100 is cancelled long after the window has passed it."""
    path, inbox, state = (fresh_path(spark, n) for n in ("facts", "inbox", "state"))
    refresh_fct_orders(path, wh.staged, wh.dim_customers)
    fixed = wh.staged.orders.withColumns(
        {
            "status": F.expr("if(order_id = 100, 'cancelled', status)"),
            "is_completed": F.expr("order_id != 100 and is_completed"),
        }
    )
    fixed.where("order_id = 100").select("order_id").write.parquet(inbox)
    now = wh.staged.replace(orders=fixed)
    arriving = spark.readStream.schema("order_id bigint").parquet(inbox)
    run = refresh_fct_orders_stream(arriving, path, state, now, lambda: wh.dim_customers)
    run.awaitTermination()
    got = {r.order_id: r.status for r in spark.read.parquet(path).collect()}
    assert got[100] == "cancelled" and len(got) == 7


def test_daily_stream_adds_late_events(spark):
    inbox, path, state = (fresh_path(spark, n) for n in ("inbox", "daily", "state"))

    def arrive(*data):
        df = spark.createDataFrame(data, "ts string, event_type string, value double")
        df.withColumn("ts", F.col("ts").cast("timestamp")).write.mode("append").parquet(inbox)
        run = daily_revenue_stream(event_stream(spark, inbox, "*.parquet"), path, state)
        run.awaitTermination()

    arrive(("2024-01-10 10:00:00", "buy", 1.25), ("2024-01-20 10:00:00", "buy", 2.0))
    arrive(("2024-01-10 23:59:59", "buy", 0.25))  # ten days late
    got = rows(daily_revenue(spark, path).select("event_date", "event_count", "total_value"))
    assert [(str(d), n, float(v)) for d, n, v in got] == [
        ("2024-01-10", 2, 1.5), ("2024-01-20", 1, 2.0),
    ]


def costs(spark, *data):
    return spark.createDataFrame(data, "product_id int, cost int")


def test_scd2_merge(spark):
    history = scd2_start(costs(spark, (1, 10), (2, 20), (3, 30), (4, None)), "2024-01-01")
    snap = costs(spark, (1, 10), (2, 25), (4, None), (5, 50))
    merged = scd2_merge(history, snap, "product_id", ["cost"], "2024-02-01")
    assert rows(merged.select("product_id", "cost", "valid_from", "valid_to", "is_current")) == [
        (1, 10, day("2024-01-01"), None, True),
        (2, 20, day("2024-01-01"), day("2024-02-01"), False),
        (2, 25, day("2024-02-01"), None, True),
        (3, 30, day("2024-01-01"), None, True),
        (4, None, day("2024-01-01"), None, True),
        (5, 50, day("2024-02-01"), None, True),
    ]
    assert rows(scd2_merge(merged, snap, "product_id", ["cost"], "2024-03-01")) == rows(merged)
    closed = scd2_merge(history, snap, "product_id", ["cost"], "2024-02-01", close_missing=True)
    assert closed.where("product_id = 3 and not is_current").count() == 1


def test_scd2_from_snapshots(spark):
    snaps = spark.createDataFrame(
        [(1, day("2024-01-01"), 5), (1, day("2024-02-01"), 5), (1, day("2024-03-01"), None),
         (1, day("2024-04-01"), 5)],
        "product_id int, seen date, cost int",
    )
    got = scd2_from_snapshots(snaps, "product_id", ["cost"], "seen").orderBy("valid_from")
    assert [(r.cost, str(r.valid_from), r.is_current) for r in got.collect()] == [
        (5, "2024-01-01", False), (None, "2024-03-01", False), (5, "2024-04-01", True),
    ]


@pytest.mark.parametrize("files", [1, 100])
def test_daily_revenue_stream_takes_events_of_any_age(spark, tmp_path, files):
    inbox, path = str(tmp_path / "inbox"), str(tmp_path / "table")
    for ts, kind in (("2024-03-01", "buy"), ("2024-03-02", None), ("2024-01-01", "buy"), ("2024-01-01", None)):
        df = spark.createDataFrame([(ts, kind, 2.5)], "ts string, event_type string, value double")
        df.withColumn("ts", F.col("ts").cast("timestamp")).coalesce(1).write.mode("append").parquet(inbox)
    events = event_stream(spark, inbox, "*.parquet", files_per_batch=files)
    daily_revenue_stream(events, path, str(tmp_path / "state")).awaitTermination()
    got = [(str(r[0]), r[1], r[2], float(r[3])) for r in daily_revenue(spark, path).collect()]
    assert sorted(got, key=str) == sorted(
        [("2024-01-01", None, 1, 2.5), ("2024-01-01", "buy", 1, 2.5), ("2024-03-01", "buy", 1, 2.5), ("2024-03-02", None, 1, 2.5)],
        key=str,
    )


def test_merge_takes_null_keys_once_and_refuses_repeated_keys(spark, tmp_path):
    path = str(tmp_path / "nulls")
    data = frame(spark, (None, "2024-01-01", "a"), (1, "2024-01-02", "b"))
    for _ in range(2):
        write_incremental(data, path, ["id"], date="d", month="m")
    assert spark.read.parquet(path).count() == 2
    with pytest.raises(ValueError, match="several updates"):
        write_incremental(frame(spark, (1, "2024-01-01", "a"), (1, "2024-01-01", "b")), path, ["id"], date="d", month="m")
    assert spark.read.parquet(path).count() == 2
