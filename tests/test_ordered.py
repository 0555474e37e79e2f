"""Distributed ranks, running sums and percentiles against plain windows and brute force."""

import random
import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from basketry.operators import ordered
from basketry.operators.ordered import stash as keep
from basketry.operators.relational import cumulative_share, pareto_shares, share_of_total
from tests.conftest import rows

SCHEMA = "g string, id int, v int"


def skewed(n=600, seed=7):
    """One group holds most rows, and one value a third of that group; NULLs everywhere."""
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        g = rnd.choice(["hot", "hot", "hot", "cold", None])
        v = rnd.choice([0, rnd.randint(-50, 50), None if i % 17 == 0 else rnd.randint(0, 9)])
        out.append((g, i, v))
    return out


def check_rank(spark, data):
    df = spark.createDataFrame(data, SCHEMA)
    plain = df.withColumn(
        "r", F.rank().over(W.partitionBy("g").orderBy(F.desc_nulls_last("v"))).cast("bigint")
    )
    assert rows(ordered.add_rank(df, ["g"], "v", "r", ties=["id"])) == rows(plain)


def test_rank_over_many_chunks(spark, many_chunks):
    data = skewed()
    df = spark.createDataFrame(data, SCHEMA)
    parts = ordered.chunked(df, ["g"], [F.desc_nulls_last("v"), F.asc("id")]).stored
    hot = parts.where("g = 'hot'").select("_chunk").distinct().count()
    ties = parts.where("g = 'hot' and v = 0").select("_chunk").distinct().count()
    assert hot > 2 and ties > 1  # the hot group and its hot value do span chunks
    check_rank(spark, data)


def test_one_chunking_serves_finer_groups(spark, many_chunks):
    """Rank within (g, h) and running sum within g, from rows chunked by g."""
    df = spark.createDataFrame(skewed(), SCHEMA).withColumn("h", F.col("id") % 3)
    order = [F.desc_nulls_last("v"), F.asc("id")]
    got = (
        ordered.chunked(df, ["g"], order)
        .with_rank(["g", "h"], "v", "r")
        .with_running(["g"], order, sums={"s": "v"})
        .result()
    )
    rank_in = W.partitionBy("g", "h").orderBy(F.desc_nulls_last("v"))
    run_in = W.partitionBy("g").orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
    plain = df.withColumns(
        {"r": F.rank().over(rank_in).cast("bigint"), "s": F.sum("v").over(run_in)}
    )
    assert rows(got) == rows(plain)


def test_rank_when_one_value_fills_whole_chunks(spark, many_chunks):
    check_rank(spark, [("hot", i, 5 if i > 20 else i) for i in range(300)])
    check_rank(spark, [("hot", i, 5) for i in range(100)])
    check_rank(spark, [("hot", i, None) for i in range(50)] + [(None, 51, 3), (None, 52, 3)])


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.sampled_from(["a", "b", None]), st.integers(0, 4)), max_size=40))
def test_rank_of_any_data(spark, many_chunks, pairs):
    check_rank(spark, [(g, i, v) for i, (g, v) in enumerate(pairs)])


def test_positions_and_running_sums(spark, many_chunks):
    df = spark.createDataFrame(skewed(), SCHEMA)
    order = [F.desc_nulls_last("v"), F.asc("id")]
    here = W.partitionBy("g").orderBy(*order)
    group = W.partitionBy("g")
    plain = df.withColumns(
        {
            "run": F.sum("v").over(here.rowsBetween(W.unboundedPreceding, 0)),
            "whole": F.sum("v").over(group),
            "pos": F.row_number().over(here).cast("bigint"),
            "n": F.count(F.lit(1)).over(group),
        }
    )
    got = ordered.add_running(
        df, ["g"], order, position="pos", sums={"run": "v"}, size="n", totals={"whole": "v"}
    )
    assert got.columns == plain.columns
    assert rows(got) == rows(plain)


def test_running_without_groups(spark, many_chunks):
    df = spark.range(100).select(F.col("id").cast("int").alias("id"))
    got = ordered.add_running(df, [], [F.asc("id")], position="pos", sums={"s": "id"})
    assert {tuple(r) for r in got.collect()} == {
        (i, i * (i + 1) // 2, i + 1) for i in range(100)
    }


@pytest.mark.parametrize("n", [1, 2, 5, 101])
def test_percentiles_match_the_built_in(spark, many_chunks, n):
    rnd = random.Random(n)
    data = [("a", i, rnd.choice([0, rnd.randint(0, 99)])) for i in range(n)] + [("b", 0, None)]
    df = spark.createDataFrame(data, SCHEMA)
    points = {"p50": 0.5, "p90": 0.9, "p0": 0.0, "p100": 1.0}
    got = ordered.exact_percentiles(df, ["g"], "v", points, ties=["id"]).collect()
    want = df.where("g = 'a'").agg(*[F.percentile("v", p).alias(c) for c, p in points.items()])
    assert [r["g"] for r in got] == ["a"]  # a group without values has no percentiles
    for name, value in want.first().asDict().items():
        assert got[0][name] == pytest.approx(value)


@pytest.mark.parametrize("kind", ["long", "double", "decimal(28,6)"])
def test_percentiles_of_any_values(spark, monkeypatch, kind):
    """Spread over many powers of ten, ties, a hot group, one of two rows; few ranges per round."""
    monkeypatch.setattr(ordered, "CELLS", 16)
    rnd = random.Random(5)
    top = {"long": 18, "double": 300, "decimal(28,6)": 21}[kind]
    data = [("hot", rnd.choice([-1, 1]) * rnd.randint(1, 9) * 10 ** rnd.randint(0, top)) for _ in range(500)]
    data += [("hot", 7)] * 300 + [(None, 3), (None, 8), ("one", 5), ("none", None)]
    df = spark.createDataFrame([(g, str(v) if v is not None else None) for g, v in data], "g string, v string")
    df = df.withColumn("v", F.col("v").cast("double").cast(kind) if kind == "double" else F.col("v").cast(kind))
    points = {"p0": 0.0, "p5": 0.05, "p50": 0.5, "p77": 0.77, "p100": 1.0}
    got = {r["g"]: r for r in ordered.exact_percentiles(df, ["g"], "v", points).collect()}
    assert set(got) == {"hot", None, "one"}
    for group in got:
        values = sorted(float(v) for g, v in data if g == group and v is not None)
        for name, p in points.items():
            at = p * (len(values) - 1)
            low, part = int(at), at - int(at)
            high = values[min(low + 1, len(values) - 1)] if part else values[low]
            want = values[low] * (1 - part) + high * part
            assert got[group][name] == pytest.approx(want, rel=1e-12)


def test_percentiles_shuffle_counts_and_no_rows(spark, monkeypatch):
    """Every shuffle holds at most a row per task, group and range, however many rows there are."""
    stored = []
    monkeypatch.setattr(ordered, "stash", lambda df, label: stored.append(df) or keep(df, label))
    df = spark.range(20_000).select((F.col("id") % 2).alias("g"), F.hash("id").cast("long").alias("v"))
    ordered.exact_percentiles(df, ["g"], "v", {"p50": 0.5}).collect()
    for frame in stored:
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert "rangepartitioning" not in plan
        for line in re.findall(r"Exchange hashpartitioning\(([^)]*)", plan):
            assert "_group" in line or "_lo" in line
    assert len(stored) <= 6


def test_chunks_grow_with_the_input(spark, monkeypatch):
    assert [ordered.chunk_count(n, 8) for n in (0, 1, 20_000, 10**6, 10**8)] == [1, 1, 4, 8, 100]
    monkeypatch.setattr(ordered, "CHUNK_ROWS", 100)
    monkeypatch.setattr(ordered, "LEAST_CHUNK_ROWS", 100)
    order = [F.asc("id")]
    numbers = []
    for n in (500, 5_000):
        df = spark.range(n).select(F.lit("hot").alias("g"), F.col("id").cast("int").alias("id"), F.lit(1).alias("v"))
        chunks = ordered.chunked(df, ["g"], order)
        numbers.append(chunks.stored.select("_chunk").distinct().count())
        sizes = [r[1] for r in chunks.stored.groupBy("_chunk").count().collect()]
        assert max(sizes) < 300
    assert numbers[0] == 5 and 45 <= numbers[1] <= 50


def test_windows_after_chunking_share_one_exchange_of_rows(spark):
    df = spark.createDataFrame(skewed(), SCHEMA).withColumn("h", F.col("id") % 3)
    order = [F.desc_nulls_last("v"), F.asc("id")]
    out = ordered.chunked(df, ["g"], order).with_rank(["g", "h"], "v", "r")
    out = out.with_running(["g"], order, sums={"s": "v"}, totals={"t": "v"}).result()
    out.collect()
    plan = out._jdf.queryExecution().executedPlan().toString()
    final = plan.split("== Initial Plan ==")[0]
    assert final.count("REPARTITION_BY_COL") == 1
    # the other shuffles are of per-chunk totals: none partitions rows by chunk for a window
    rows_again = [e for e in re.findall(r"Exchange hashpartitioning\(_chunk[^\n]*", final) if "REPARTITION" not in e]
    assert all("_group" in e for e in rows_again)


def test_shares(spark, many_chunks):
    df = spark.createDataFrame(
        [("a", 1, 60), ("a", 2, 30), ("a", 3, 10), (None, 4, 5), ("z", 5, 0)], SCHEMA
    )
    by_value = [F.desc("v"), F.asc("id")]
    both = pareto_shares(df, ["g"], by_value, "v", "pct", "cum").orderBy("id")
    assert [(r.pct, r.cum) for r in both.collect()] == [
        (60.0, 60.0), (30.0, 90.0), (10.0, 100.0), (100.0, 100.0), (None, None),
    ]
    alone = share_of_total(df, ["g"], "v", "pct").orderBy("id")
    assert [r.pct for r in alone.collect()] == [60.0, 30.0, 10.0, 100.0, None]
    running = cumulative_share(df, ["g"], by_value, "v", "cum").orderBy("id")
    assert [r.cum for r in running.collect()][:3] == [60.0, 90.0, 100.0]
