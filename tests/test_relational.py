from pyspark.sql import functions as F

from basketry.operators import relational as r
from basketry.operators import series
from basketry.sources import as_view, source, write_table
from basketry.session import fresh_path
from tests.conftest import day, rows


def test_union_relations_aligns_columns(spark):
    a = spark.createDataFrame([(1, "x")], "id int, only_a string")
    b = spark.createDataFrame([(2, 5.0)], "id int, only_b double")
    out = r.union_relations({"a": a, "b": b})
    assert out.columns == ["id", "only_a", "_source_relation", "only_b"]
    assert rows(out) == [(1, "x", "a", None), (2, None, "b", 5.0)]
    assert out.count() == a.count() + b.count()
    assert "_source_relation" not in r.union_relations({"a": a, "b": b}, None).columns


def test_pivot_and_unpivot(spark):
    df = spark.createDataFrame([("k", "a", 1), ("k", "a", 2), ("k", "c", 9), ("l", "b", 4)],
                               "k string, c string, v int")
    wide = r.pivot_sum(df, ["k"], "c", ["a", "b"], "v")
    assert rows(wide) == [("k", 3, 0), ("l", 0, 4)]
    long = r.unpivot(wide, ["k"], ["a", "b"], "c", "v")
    assert rows(long) == [("k", "a", 3), ("k", "b", 0), ("l", "a", 0), ("l", "b", 4)]


def test_column_values_and_top(spark):
    df = spark.createDataFrame([("k", 3), ("k", 5), ("k", 5), ("l", None)], "k string, v int")
    assert rows(r.column_values(df, "v")) == [(3, 1), (5, 2)]
    best = r.top_n(df, ["k"], [F.desc_nulls_last("v")], 2)
    assert rows(best) == [("k", 5), ("k", 5), ("l", None)]
    ranked = df.withColumn("rk", F.lit(1))
    assert r.top_k_by_rank(ranked, "rk", 1).count() == 4


def test_series_windows(spark):
    df = spark.createDataFrame(
        [("a", day(f"2024-01-{d:02d}"), d) for d in range(1, 11)] + [(None, day("2024-01-05"), 7)],
        "s string, d date, v int",
    )
    out = series.rolling_avg(df, ["s"], ["d"], "v", "avg3", 3)
    out = series.rolling_sum(out, ["s"], ["d"], "v", "sum3", 3)
    out = series.running_total(out, ["s"], ["d"], "v", "run")
    out = series.lag_value(out, ["s"], ["d"], "v", "prev")
    out = series.days_since_start(out, ["s"], "d", "age")
    got = {(x.s, x.v): x for x in out.collect()}
    assert (got[("a", 1)].avg3, got[("a", 10)].avg3, got[("a", 10)].sum3) == (1.0, 9.0, 27)
    assert (got[("a", 10)].run, got[("a", 1)].prev, got[("a", 10)].prev) == (55, None, 9)
    assert (got[("a", 10)].age, got[(None, 7)].age) == (9, 0)


def test_sources_and_sinks(spark):
    folder = fresh_path(spark, "tables")
    df = spark.range(20).select("id", (F.col("id") % 2).alias("part"))
    stored = write_table(df, f"{folder}/raw_things", partition_by="part", sort_by=["id"])
    assert rows(stored.select("id", "part")) == rows(df)
    assert source(spark, "things", folder).count() == 20
    assert source(spark, "x", folder, {"x": "raw_things"}).where("part = 1").count() == 10
    write_table(df.limit(3), f"{folder}/raw_things")
    assert source(spark, "things", folder).count() == 3
    as_view(df, "things_view")
    assert source(spark, "t", identifiers={"t": "things_view"}).count() == 20
