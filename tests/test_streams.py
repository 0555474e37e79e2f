"""Streams that are started again, replayed, compacted, or see rows out of order."""

import os

import pytest
from pyspark.sql import functions as F

from basketry.plans.refresh import refresh_fct_orders
from basketry.plans.warehouse import Warehouse
from basketry.session import fresh_path, freed_stashes, shared_dir, stash, subfolders
from basketry.streaming.jobs import event_stream, refresh_fct_orders_stream
from basketry.streaming.totals import compact_daily_revenue, daily_revenue, daily_revenue_stream
from tests import shop
from tests.conftest import rows


def arrive(spark, inbox, *data):
    df = spark.createDataFrame(data, "ts string, event_type string, value double")
    df.withColumn("ts", F.col("ts").cast("timestamp")).coalesce(1).write.mode("append").parquet(inbox)


def drain(spark, inbox, path, state, **more):
    events = event_stream(spark, inbox, "*.parquet", files_per_batch=1)
    daily_revenue_stream(events, path, state, **more).awaitTermination()


def totals(spark, path):
    return [(str(r[0]), r[1], r[2], float(r[3])) for r in rows(daily_revenue(spark, path))]


@pytest.fixture
def paths(tmp_path):
    return [str(tmp_path / n) for n in ("inbox", "totals", "state")]


def parts(path):
    return [d for d, _, files in os.walk(path) if any(f.endswith(".parquet") for f in files)]


def test_runs_with_other_checkpoints_add_up(spark, paths, tmp_path):
    inbox, path, state = paths
    assert totals(spark, path) == []
    arrive(spark, inbox, ("2024-01-01", "buy", 1.0))
    drain(spark, inbox, path, state)
    other = str(tmp_path / "other")
    arrive(spark, other, ("2024-01-01", "buy", 2.5), ("2024-01-02", None, 1.0))
    drain(spark, other, path, str(tmp_path / "other-state"))
    want = [("2024-01-01", "buy", 2, 3.5), ("2024-01-02", None, 1, 1.0)]
    assert totals(spark, path) == want
    drain(spark, inbox, path, state)  # nothing new
    assert totals(spark, path) == want


def test_a_replay_replaces_its_own_batch_only(spark, paths):
    inbox, path, state = paths
    for value in (1.0, 2.0, 4.0):
        arrive(spark, inbox, ("2024-01-01", "buy", value))
        drain(spark, inbox, path, state)
    last = sorted(n for n in os.listdir(f"{state}/commits") if not n.startswith("."))[-1]
    os.rename(f"{state}/commits/{last}", f"{state}/lost-commit")  # written, but not committed
    os.rename(f"{state}/commits/.{last}.crc", f"{state}/.lost-commit.crc")
    drain(spark, inbox, path, state)
    assert totals(spark, path) == [("2024-01-01", "buy", 3, 7.0)]
    compact_daily_revenue(spark, path)
    assert totals(spark, path) == [("2024-01-01", "buy", 3, 7.0)]


def test_ten_batches_leave_no_more_parts_than_two(spark, paths):
    inbox, path, state = paths
    for day in range(10):
        arrive(spark, inbox, (f"2024-01-{day // 2 + 1:02}", "buy", 1.0))
    drain(spark, inbox, path, state, compact_every=3)
    want = [(f"2024-01-0{d + 1}", "buy", 2, 2.0) for d in range(5)]
    assert totals(spark, path) == want
    assert len(parts(path)) < 10  # compacted on the way
    for _ in range(2):
        compact_daily_revenue(spark, path)
        assert totals(spark, path) == want
        assert len(parts(path)) == 2
    arrive(spark, inbox, ("2024-01-05", "buy", 1.0))
    drain(spark, inbox, path, state, compact_every=3)
    assert totals(spark, path) == [*want[:-1], ("2024-01-05", "buy", 3, 3.0)]


def order_level(df):
    return rows(df.select("order_id", "status", "net_sales", "return_count", "primary_product_id"))


def test_returns_wait_for_their_lines(spark, tmp_path):
    """The lines of the first batch's returns come when the second batch does."""
    wh = Warehouse(shop.raw(spark))
    s, customers = wh.staged, wh.dim_customers
    path, inbox, state = (str(tmp_path / n) for n in ("facts", "inbox", "state"))
    refresh_fct_orders(path, s.replace(returns=s.returns.limit(0)), customers)
    for ids in ([1001, None], [4711], [1006]):
        kept = s.returns.where(F.col("order_item_id").isin(ids)) if ids != [4711] else s.returns.limit(1)
        out = kept.select("return_id", "order_item_id")
        if None in ids:
            out = out.unionByName(spark.createDataFrame([(1, None)], out.schema))
        if ids == [4711]:
            out = out.withColumn("order_item_id", F.lit(4711).cast("bigint"))  # has no line ever
        out.coalesce(1).write.mode("append").parquet(inbox)
    no_line = s.replace(order_items=s.order_items.where("order_item_id != 1001"))
    batches = iter([no_line, no_line])
    schema = spark.read.parquet(inbox).schema
    arriving = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(inbox)
    run = refresh_fct_orders_stream(
        arriving, path, state, lambda: next(batches, s), customers, waiting=str(tmp_path / "waiting")
    )
    run.awaitTermination()
    assert order_level(spark.read.parquet(path)) == order_level(wh.fct_orders)
    kept = subfolders(spark, str(tmp_path / "waiting"))
    assert len(kept) <= 2
    last = spark.read.parquet(f"{tmp_path}/waiting/{max(kept)}")
    assert rows(last) == [(4711,)]


def test_batches_leave_no_stashes(spark, tmp_path):
    wh = Warehouse(shop.raw(spark))
    customers, s = wh.dim_customers, wh.staged
    counts = []
    root = f"{shared_dir(spark)}/basketry-{spark.sparkContext.applicationId}"
    for batches in (2, 6):
        path, inbox, state = (str(tmp_path / f"{n}{batches}") for n in ("facts", "inbox", "state"))
        refresh_fct_orders(path, s, customers)
        for k in range(batches):
            write = s.returns.limit(k + 1).select("return_id", "order_item_id").coalesce(1).write
            write.mode("append").parquet(inbox)
        schema = spark.read.parquet(inbox).schema
        arriving = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(inbox)
        before = len(subfolders(spark, root))
        refresh_fct_orders_stream(arriving, path, state, s, customers).awaitTermination()
        counts.append(len(subfolders(spark, root)) - before)
    assert counts == [0, 0]


def test_scopes_free_what_was_stashed_inside(spark):
    outside = stash(spark.range(3).toDF("a"), "kept")
    with freed_stashes(spark):
        with freed_stashes(spark):
            inner = fresh_path(spark, "inner")
            spark.range(1).write.parquet(inner)
        assert not os.path.exists(inner)
        stash(spark.range(2).toDF("a"), "gone")
    assert outside.count() == 3
