"""Layout of stored tables: footers answer for bounds, clustered files skip row groups."""

import glob

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from basketry.operators.checks import check_freshness, check_freshness_stored
from basketry.sources import footer_bounds, write_table
from basketry.sources.tables import morton_cell
from tests.conftest import day, rows


def groups_that_may_hold(path, column, value):
    """(row groups whose bounds include the value, all row groups)."""
    hit = total = 0
    for file in glob.glob(f"{path}/**/*.parquet", recursive=True):
        meta = pq.ParquetFile(file).metadata
        at = meta.schema.to_arrow_schema().names.index(column)
        for g in range(meta.num_row_groups):
            stats = meta.row_group(g).column(at).statistics
            total += 1
            hit += stats.min <= value <= stats.max
    return hit, total


def test_a_filter_on_either_column_skips_row_groups(spark, tmp_path):
    n = 40_000
    df = spark.range(n).select(
        F.col("id").alias("order_id"),
        F.date_add(F.lit(day("2024-01-01")), F.pmod(F.hash("id"), F.lit(31))).alias("order_date"),
        F.pmod(F.hash("id", F.lit(1)), F.lit(5000)).alias("customer_id"),
        F.lit("2024-01").alias("m"),
    )
    spark.conf.set("parquet.block.size", str(16 << 10))
    spark.conf.set("parquet.block.size.row.check.min", "100")
    try:
        by_date, clustered = str(tmp_path / "sorted"), str(tmp_path / "clustered")
        options = {"partition_by": "m"}
        write_table(df, by_date, sort_by=["order_date", "customer_id", "order_id"], **options)
        write_table(df, clustered, sort_by=["order_id"], cluster_by=["order_date", "customer_id"], **options)
    finally:
        spark.conf.unset("parquet.block.size")
        spark.conf.unset("parquet.block.size.row.check.min")
    assert rows(spark.read.parquet(clustered).groupBy().count()) == [(n,)]
    def share_read(path, column, values):
        found = [groups_that_may_hold(path, column, v) for v in values]
        assert all(total >= 30 for _, total in found)
        return sum(hit for hit, _ in found) / sum(total for _, total in found)

    customers, dates = range(100, 5000, 250), [day(f"2024-01-{d:02}") for d in range(2, 31, 4)]
    assert share_read(by_date, "customer_id", customers) > 0.9  # a plain sort serves its first column only
    assert share_read(clustered, "customer_id", customers) < 0.4
    assert share_read(clustered, "order_date", dates) < 0.4


def test_cells_take_nulls_ties_and_odd_types(spark):
    data = [(i % 3 or None, float(i) if i % 5 else None, day("2024-01-01") if i % 2 else None) for i in range(100)]
    df = spark.createDataFrame(data, "a int, b double, d date")
    cells = [r[0] for r in df.select(morton_cell(df, ["a", "b", "d"], 3)).collect()]
    assert len(set(cells)) > 5 and min(cells) == 0 and max(cells) < 2**9
    none = df.limit(0)
    assert none.select(morton_cell(none, ["a", "b"])).count() == 0
    with pytest.raises(ValueError, match="cannot cluster"):
        morton_cell(df.withColumn("s", F.lit("x")), ["s"])


def test_bounds_come_from_footers(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([(day("2024-01-05"), 1), (day("2024-02-07"), 2), (None, 3)], "d date, v int")
    write_table(df, path, sort_by=["v"])
    bounds = footer_bounds(spark, path, "d")
    plan = bounds._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregation: [MIN(d), MAX(d)]" in plan
    assert rows(bounds) == [(day("2024-01-05"), day("2024-02-07"))]
    assert spark.conf.get("spark.sql.sources.useV1SourceList") != ""
    limits = {"warn_days": 3, "error_days": 9, "as_of": "2024-02-12", "name": "t"}
    assert rows(check_freshness_stored(spark, path, "d", **limits)) == rows(check_freshness(df, "d", **limits))
    write_table(df.limit(0), path, sort_by=["v"])
    assert rows(footer_bounds(spark, path, "d")) == [(None, None)]
