"""Merges that publish whole months, and the map that says which months to read."""

import os
import uuid

import pytest

from basketry.operators import published, upsert
from basketry.operators.keymonths import key_ranges, months_of_keys, within_key_ranges
from basketry.operators.published import drop_unpublished, merge_published
from basketry.operators.upsert import merged_months, stored_rows_of, write_incremental
from basketry.plans.refresh import load_facts_until, refresh_fct_orders
from basketry.plans.warehouse import Warehouse
from tests import shop
from tests.conftest import day, rows
from tests.test_incremental import frame, order_level


@pytest.fixture
def table(spark):
    name = f"kv_{uuid.uuid4().hex}"
    yield name
    spark.sql(f"DROP TABLE IF EXISTS {name}")


FIRST = [(1, "2024-01-05", "a"), (2, "2024-02-05", "b"), (3, "2024-03-05", "c"), (4, None, "n"), (None, "2024-03-09", "z")]
SECOND = [(2, "2024-01-09", "B"), (1, "2024-01-05", "A"), (5, "2024-04-01", "e"), (4, "2024-03-01", "N"), (None, "2024-03-10", "Z")]
MERGED = [
    (1, day("2024-01-05"), "A"), (2, day("2024-01-09"), "B"), (3, day("2024-03-05"), "c"),
    (4, day("2024-03-01"), "N"), (5, day("2024-04-01"), "e"), (None, day("2024-03-10"), "Z"),
]


def seen(spark, table):
    return rows(spark.table(table).select("id", "d", "v"))


def test_merge_moves_rows_and_empties_months(spark, table, tmp_path):
    merge_published(frame(spark, *FIRST), table, str(tmp_path), ["id"], "d", month="m")
    open_before = spark.table(table).select("id", "d", "v")
    old = rows(open_before)
    for _ in range(2):
        merge_published(frame(spark, *SECOND), table, str(tmp_path), ["id"], "d", month="m")
        assert seen(spark, table) == MERGED
    months = {r[0] for r in spark.sql(f"SHOW PARTITIONS {table}").collect()}
    assert months == {"m=2024-01-01", "m=2024-03-01", "m=2024-04-01"}
    assert len(old) == 5
    drop_unpublished(spark, table, str(tmp_path))
    assert seen(spark, table) == MERGED
    versions = [v for v in os.listdir(tmp_path) if v.startswith("version=")]
    folders = [m for v in versions for m in os.listdir(tmp_path / v) if m.startswith("m=")]
    assert len(folders) == 3 and len(versions) <= 3


def test_a_job_stopped_before_it_publishes_leaves_the_old_table(spark, table, tmp_path, monkeypatch):
    merge_published(frame(spark, *FIRST), table, str(tmp_path), ["id"], "d", month="m")
    before = seen(spark, table)
    files = set(spark.table(table).inputFiles())

    def stop(*args, **kwargs):
        raise KeyboardInterrupt

    with monkeypatch.context() as m:
        m.setattr(published, "publish", stop)
        with pytest.raises(KeyboardInterrupt):
            merge_published(frame(spark, *SECOND), table, str(tmp_path), ["id"], "d", month="m")
    assert seen(spark, table) == before and set(spark.table(table).inputFiles()) == files
    merge_published(frame(spark, *SECOND), table, str(tmp_path), ["id"], "d", month="m")
    assert seen(spark, table) == MERGED


def test_a_job_stopped_while_it_publishes_is_ended_by_the_next(spark, table, tmp_path, monkeypatch):
    merge_published(frame(spark, *FIRST), table, str(tmp_path), ["id"], "d", month="m")
    whole, told = published.publish, []

    def first_month_only(spark, table, month, version, emptied=frozenset()):
        told.append(version)
        name = "m=2024-01-01"
        spark.sql(f"ALTER TABLE {table} PARTITION (m = DATE '2024-01-01') SET LOCATION '{version}/{name}'")
        raise KeyboardInterrupt

    monkeypatch.setattr(published, "publish", first_month_only)
    with pytest.raises(KeyboardInterrupt):
        merge_published(frame(spark, *SECOND), table, str(tmp_path), ["id"], "d", month="m")
    # each month is whole: January is new, the others are as they were
    assert (3, day("2024-03-05"), "c") in seen(spark, table) and (1, day("2024-01-05"), "A") in seen(spark, table)
    monkeypatch.setattr(published, "publish", whole)
    merge_published(frame(spark, *SECOND), table, str(tmp_path), ["id"], "d", month="m")
    assert seen(spark, table) == MERGED


def test_published_facts_equal_a_full_rebuild(spark, table, tmp_path):
    wh = Warehouse(shop.raw(spark))
    load_facts_until(str(tmp_path), wh.staged, wh.dim_customers, "2024-02-11", table=table)
    assert spark.table(table).count() == 4
    refresh_fct_orders(str(tmp_path), wh.staged, wh.dim_customers, table=table)
    assert order_level(spark.table(table)) == order_level(wh.fct_orders)
    with pytest.raises(ValueError, match="several updates"):
        twice = frame(spark, (1, "2024-01-01", "a"), (1, "2024-01-01", "b"))
        merge_published(twice, "never_made", str(tmp_path / "x"), ["id"], "d", month="m")


def test_one_old_key_reads_one_month(spark, tmp_path):
    path = str(tmp_path / "facts")
    data = [(i, f"2024-{i // 10 % 12 + 1:02}-{i % 28 + 1:02}", "a") for i in range(240)]
    write_incremental(frame(spark, *data), path, ["id"], "d", month="m")
    assert spark.read.parquet(path).columns == ["id", "d", "v", "m"]  # the map is no part of the table
    update = frame(spark, (33, "2024-04-09", "B"))
    assert months_of_keys(spark, path, update, "id") == {day("2024-04-01")}
    old = stored_rows_of(upsert.stored_table(spark, path), update, ["id"], "m", path)
    plan = old._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "2024-04-01" in plan
    read = spark.read.parquet(path).where("m = DATE '2024-04-01'").selectExpr("_metadata.file_path f").distinct()
    used = old.sparkSession.read.parquet(path).count()
    assert used == 240 and 0 < read.count() <= 8
    write_incremental(update, path, ["id"], "d", month="m")
    moved = frame(spark, (33, "2024-09-09", "C"), (500, "2024-09-09", "new"))
    write_incremental(moved, path, ["id"], "d", month="m")
    got = {r["id"]: (str(r["d"]), r["v"]) for r in spark.read.parquet(path).collect()}
    assert len(got) == 241 and got[33] == ("2024-09-09", "C") and got[500] == ("2024-09-09", "new")
    assert day("2024-09-01") in months_of_keys(spark, path, update, "id")


def test_a_lost_map_is_made_again_from_the_table(spark, tmp_path):
    from basketry.operators.keymonths import forget_months

    path = str(tmp_path / "facts")
    write_incremental(frame(spark, *FIRST), path, ["id"], "d", month="m")
    forget_months(spark, path)
    assert months_of_keys(spark, path, frame(spark, (3, None, "")), "id") is None
    for _ in range(2):
        write_incremental(frame(spark, *SECOND), path, ["id"], "d", month="m")
        assert rows(spark.read.parquet(path).select("id", "d", "v")) == MERGED
    assert months_of_keys(spark, path, frame(spark, (3, None, "")), "id") == {day("2024-03-01")}


def test_few_old_keys_do_not_widen_the_range(spark):
    keys = spark.range(900_000, 1_000_000).unionByName(spark.createDataFrame([(7,), (None,)], "id long"))
    assert key_ranges(keys, "id") == [(7, 7), (900_000, 999_999)]
    near = within_key_ranges(spark.range(0, 1_000_000, 100).toDF("id"), keys, "id")
    assert near.count() == 1000
    assert within_key_ranges(keys, keys, "id").count() == 100_002  # NULL keys as well
    words = spark.createDataFrame([("b",), ("d",)], "id string")
    assert key_ranges(words, "id") == [("b", "d")] and key_ranges(words.limit(0), "id") is None
    assert within_key_ranges(words, words.limit(0), "id").count() == 0
    wide = spark.createDataFrame([(-(2**63),), (2**63 - 1,), (0,)], "id long")
    assert within_key_ranges(wide, wide, "id").count() == 3


def test_rows_that_stay_are_not_shuffled(spark, tmp_path):
    path = str(tmp_path / "facts")
    data = [(i, f"2024-{i // 10 % 12 + 1:02}-{i % 28 + 1:02}", "a") for i in range(240)]
    write_incremental(frame(spark, *data), path, ["id"], "d", month="m")
    new = frame(spark, (33, "2024-04-09", "B"), (None, "2024-04-10", "n")).selectExpr("*", "trunc(d, 'MM') AS m")
    merged = merged_months(upsert.stored_table(spark, path), new, ["id"], "m", {day("2024-04-01")}, ["d", "id"])
    plan = merged._jdf.queryExecution().executedPlan().toString()
    assert plan.count("REBALANCE") == 1 and "Join" in plan.split("REBALANCE")[0]
    assert "Join" not in plan.split("REBALANCE")[1] and "hashpartitioning(id" not in plan
    got = rows(merged.select("id", "v"))
    assert len(got) == 21 and {(33, "B"), (None, "n"), (34, "a")} <= set(got)


def month_files(path, month):
    return [f for f in os.listdir(f"{path}/m={month}") if f.endswith(".parquet")]


@pytest.mark.parametrize("few", [0, 100])
def test_a_month_in_many_small_files_is_dealt_anew(spark, table, tmp_path, monkeypatch, few):
    monkeypatch.setattr(upsert, "FEW_UPDATES", few)
    monkeypatch.setattr(upsert, "MONTH_FILES", 3)
    path = str(tmp_path / "facts")
    want = {}
    for i in range(7):
        new = [(i, "2024-01-05", f"a{i}"), (100, "2024-01-06", f"b{i}"), (200 + i, "2024-02-05", "c")]
        want |= {k: v for k, _, v in new}
        write_incremental(frame(spark, *new), path, ["id"], "d", month="m", sort_by=["d"])
        merge_published(frame(spark, *new), table, str(tmp_path / "p"), ["id"], "d", month="m", sort_by=["d"])
        assert dict(rows(spark.read.parquet(path).select("id", "v"))) == want
        assert dict(rows(spark.table(table).select("id", "v"))) == want
        assert len(month_files(path, "2024-01-01")) <= 4


def test_a_first_load_is_checked_before_it_is_published(spark, table, tmp_path):
    twice = frame(spark, (1, "2024-01-01", "a"), (1, "2024-02-01", "b"))
    with pytest.raises(ValueError, match="several updates"):
        merge_published(twice, table, str(tmp_path), ["id"], "d", month="m")
    assert not spark.catalog.tableExists(table) and not os.listdir(tmp_path)
