"""Set operations and reshaping."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .ordered import Chunked, add_group_total, chunked


def union_relations(
    relations: Mapping[str, DataFrame], source_column: str | None = "_source_relation"
) -> DataFrame:
    """UNION ALL by column name; missing columns become NULL, a tag names the relation."""

    def tagged(name: str) -> DataFrame:
        df = relations[name]
        return df.withColumn(source_column, F.lit(name)) if source_column else df

    return reduce(
        lambda a, b: a.unionByName(b, allowMissingColumns=True), [tagged(n) for n in relations]
    )


def pivot_sum(
    df: DataFrame, keys: Sequence[str], column: str, values: Sequence[str], measure: str
) -> DataFrame:
    """One column per listed value with the sum of ``measure``; 0 where there is none."""
    wide = df.groupBy(*keys).pivot(column, list(values)).agg(F.sum(measure))
    return wide.na.fill(0, subset=list(values))


def unpivot(
    df: DataFrame, ids: Sequence[str], columns: Sequence[str], variable: str, value: str
) -> DataFrame:
    """One row per id and column; the measures must share a type (cast them first)."""
    return df.unpivot(list(ids), list(columns), variable, value)


def column_values(df: DataFrame, column: str) -> DataFrame:
    """Distinct non-NULL values with their row counts, most frequent first when sorted."""
    return (
        df.where(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("value"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


def top_n(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int = 1) -> DataFrame:
    """The first ``n`` rows per key.  Spark limits each group before the shuffle."""
    rn = F.row_number().over(W.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rn", rn).where(F.col("_rn") <= n).drop("_rn")


def top_k_by_rank(df: DataFrame, rank_col: str, k: int = 5) -> DataFrame:
    """Rows ranked ``k`` or better; ties at the limit are all kept."""
    return df.where(F.col(rank_col) <= k)


def share_of_total(df: DataFrame, groups: Sequence[str], col: str, name: str) -> DataFrame:
    """Percent of the group's total; NULL where that total is 0."""
    total = F.col("_total").cast("double")
    share = F.when(total != 0, F.col(col).cast("double") * 100.0 / total)
    return add_group_total(df, groups, col, "_total").withColumn(name, share).drop("_total")


def pareto_of_chunks(
    chunks: Chunked,
    groups: Sequence[str],
    order: Sequence[Column],
    col: str,
    share: str,
    cumulative: str,
) -> DataFrame:
    """Percent of the group's total per row, and its running percent along ``order``.

    Both are NULL where the total is 0.  ``order`` must tell the rows of a group apart.
    """
    out = chunks.with_running(groups, order, sums={"_running": col}, totals={"_total": col})
    total = F.col("_total").cast("double")

    def percent(part: str) -> Column:
        return F.when(total != 0, F.col(part).cast("double") * 100.0 / total)

    added = out.result().withColumns({share: percent(col), cumulative: percent("_running")})
    return added.drop("_running", "_total")


def pareto_shares(
    df: DataFrame,
    groups: Sequence[str],
    order: Sequence[Column],
    col: str,
    share: str,
    cumulative: str,
) -> DataFrame:
    """``pareto_of_chunks`` for a frame that is not chunked yet."""
    return pareto_of_chunks(chunked(df, groups, order), groups, order, col, share, cumulative)


def cumulative_share(
    df: DataFrame, groups: Sequence[str], order: Sequence[Column], col: str, name: str
) -> DataFrame:
    """Running percent of the group's total along ``order``."""
    return pareto_shares(df, groups, order, col, "_share", name).drop("_share")
