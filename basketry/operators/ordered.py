"""Ranks, positions, running totals and percentiles over groups of any size.

A plain window sends each group to one task, which does not work when a group (a customer
segment, say) holds a large share of all rows.  Here the rows are range-partitioned on
(group, sort order), so one group spans many chunks and equal values may too.  The chunked
rows are stored once; each chunk then ranks and sums its own part, and the totals of the
earlier chunks of the group are added.  The per-chunk totals have one row per chunk and
group, so the last step works on a small table.  The stored rows are dealt out by chunk once, and
every window that follows finds them so.

Percentiles need no order at all: the ranges that hold the wanted positions are counted finer
and finer.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import stash

CHUNK_ROWS = 1_000_000  # rows of a chunk in large tables
LEAST_CHUNK_ROWS = 5_000  # small tables are cut for the cores there are, but no finer
CELLS = 4096  # ranges that an interval of values is counted in

_BEFORE = (W.unboundedPreceding, -1)
_UP_TO_HERE = (W.unboundedPreceding, W.currentRow)


def _group_key(groups: Sequence[str]) -> Column:
    # a struct compares equal on NULL fields, so NULL groups join like any other
    return F.struct(*groups) if groups else F.struct(F.lit(0).alias("all"))


@dataclass(frozen=True)
class Chunked:
    """Rows stored in global order with a chunk number, and columns added to them so far.

    Per-chunk totals are always taken from the stored rows, so several columns can be added
    without computing the earlier ones again.
    """

    stored: DataFrame
    rows: DataFrame

    def result(self) -> DataFrame:
        return self.rows.drop("_chunk")

    def _add(self, groups, local: dict[str, Column], per_chunk: DataFrame, added) -> Chunked:
        """Window columns per chunk, joined to the per-chunk table (broadcast when small)."""
        rows = self.rows.withColumn("_group", _group_key(groups)).withColumns(local)
        joined = rows.join(per_chunk, ["_chunk", "_group"])
        return replace(self, rows=joined.select(*self.rows.columns, *added))

    def with_running(
        self,
        groups: Sequence[str],
        order: Sequence[Column],
        position: str | None = None,
        sums: dict[str, str] | None = None,
        size: str | None = None,
        totals: dict[str, str] | None = None,
    ) -> Chunked:
        """Add row position, running sums, group size and group totals.

        ``order`` is the order of the chunks and must tell all rows of a group apart.
        ``sums`` maps a new column to the column it accumulates (ROWS up to the current
        row); ``totals`` maps a new column to the column it sums over the whole group.
        """
        sums, totals = sums or {}, totals or {}
        earlier = W.partitionBy("_group").orderBy("_chunk").rowsBetween(*_BEFORE)
        whole = W.partitionBy("_group")
        per_chunk = (
            self.stored.groupBy("_chunk", _group_key(groups).alias("_group"))
            .agg(
                F.count(F.lit(1)).alias("_n"),
                *[F.sum(c).alias(f"_sum_{n}") for n, c in {**sums, **totals}.items()],
            )
            .select(
                "_chunk",
                "_group",
                F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_n_before"),
                F.sum("_n").over(whole).alias("_size"),
                *[F.sum(f"_sum_{n}").over(earlier).alias(f"_before_{n}") for n in sums],
                *[F.sum(f"_sum_{n}").over(whole).alias(f"_total_{n}") for n in totals],
            )
        )
        here = W.partitionBy("_chunk", "_group").orderBy(*order)
        so_far = here.rowsBetween(*_UP_TO_HERE)
        local = {f"_run_{n}": F.sum(c).over(so_far) for n, c in sums.items()}

        def plus(name: str, column: str) -> Column:
            # like SUM, NULL only while no value has been seen
            before, run = F.col(f"_before_{name}"), F.col(f"_run_{name}")
            total = F.coalesce(before + run, before, run)
            kind = self.stored.select(F.sum(column)).schema[0].dataType
            return total.cast(kind).alias(name)

        added = [plus(n, c) for n, c in sums.items()]
        added += [F.col(f"_total_{n}").alias(n) for n in totals]
        if position:
            local["_position"] = F.row_number().over(here)
            added.append((F.col("_n_before") + F.col("_position")).alias(position))
        if size:
            added.append(F.col("_size").alias(size))
        return self._add(groups, local, per_chunk, added)

    def with_rank(self, groups: Sequence[str], value: str, name: str) -> Chunked:
        """Add SQL ``rank()`` by ``value`` descending (NULLs last) within ``groups``.

        The chunks must be in an order that has ``value`` descending within each group;
        ``groups`` may be finer than the groups the rows were chunked by.  Rows that
        continue a value of an earlier chunk take the rank the value got where it began.
        """
        boxed = F.struct(F.col(value))  # keeps a NULL value as the smallest
        by_chunk = W.partitionBy("_group").orderBy("_chunk")
        before = F.coalesce(F.sum("_n").over(by_chunk.rowsBetween(*_BEFORE)), F.lit(0))
        goes_on = F.lag("_last").over(by_chunk) == F.col("_first")
        values = self.stored.select("_chunk", _group_key(groups).alias("_group"), boxed.alias("_v"))
        ends = values.groupBy("_chunk", "_group").agg(
            F.count(F.lit(1)).alias("_n"), F.max("_v").alias("_first"), F.min("_v").alias("_last")
        )
        ends = stash(ends, "chunk-ends")
        # rows of the chunk's last value, counted without an order
        last = values.join(ends.select("_chunk", "_group", "_last"), ["_chunk", "_group"])
        tails = last.where(F.col("_v") == F.col("_last")).groupBy("_chunk", "_group")
        per_chunk = (
            ends.join(tails.agg(F.count(F.lit(1)).alias("_tail")), ["_chunk", "_group"])
            .withColumn("_before", before)
            # rank of the chunk's last value, counted from the chunk in which it began
            .withColumn(
                "_began",
                F.min(F.col("_before") + F.col("_n") - F.col("_tail") + 1).over(
                    W.partitionBy("_group", "_last")
                ),
            )
            .select(
                "_chunk",
                "_group",
                "_before",
                "_first",
                F.when(goes_on, F.lag("_began").over(by_chunk)).alias("_head_rank"),
            )
        )
        here = W.partitionBy("_chunk", "_group").orderBy(F.desc_nulls_last(value))
        continues = (boxed == F.col("_first")) & F.col("_head_rank").isNotNull()
        rank = F.when(continues, F.col("_head_rank")).otherwise(F.col("_before") + F.col("_rank"))
        return self._add(groups, {"_rank": F.rank().over(here)}, per_chunk, [rank.alias(name)])


def chunk_count(rows: int, cores: int) -> int:
    """Number of chunks: one for ``CHUNK_ROWS`` rows, or one per core while chunks stay worth it."""
    return max(1, -(-rows // CHUNK_ROWS), min(cores, -(-rows // LEAST_CHUNK_ROWS)))


def chunked(
    df: DataFrame, groups: Sequence[str], order: Sequence[Column], chunks: int | None = None
) -> Chunked:
    """Store ``df`` in global (groups, order) order with a chunk number per row.

    The rows are stored first as they come: their number, which Parquet footers tell, gives the number of
    chunks, and the bounds of the ranges are found without computing the frame twice.  The chunk
    number is written with the rows: later steps read the same assignment even if a task is rerun.
    """
    given = stash(df, "to-chunk")
    if chunks is None:
        chunks = chunk_count(given.count(), df.sparkSession.sparkContext.defaultParallelism)
    ranged = given.repartitionByRange(chunks, *[F.asc_nulls_first(g) for g in groups], *order)
    stored = stash(ranged.withColumn("_chunk", F.spark_partition_id()), "chunked")
    # windows by chunk and any group are computed where this puts the rows
    return Chunked(stored, stored.repartition("_chunk"))


def add_running(
    df: DataFrame, groups: Sequence[str], order: Sequence[Column], **columns
) -> DataFrame:
    """Chunk the rows and add what ``Chunked.with_running`` offers."""
    return chunked(df, groups, order).with_running(groups, order, **columns).result()


def add_rank(
    df: DataFrame, groups: Sequence[str], value: str, name: str, ties: Sequence[str] = ()
) -> DataFrame:
    """Chunk the rows and add their rank by ``value`` descending within ``groups``.

    ``ties`` are further columns that spread rows of one value over several chunks; they do
    not change the rank.
    """
    order = [F.desc_nulls_last(value), *[F.asc_nulls_first(t) for t in ties]]
    return chunked(df, groups, order).with_rank(groups, value, name).result()


def add_group_total(df: DataFrame, groups: Sequence[str], value: str, name: str) -> DataFrame:
    """Sum of ``value`` over the row's group, by aggregate and join instead of a window.

    No group is gathered in one task.  The frame is read twice, so store it first if it is
    costly.
    """
    key = _group_key(groups)
    totals = df.groupBy(key.alias("_group")).agg(F.sum(value).alias(name))
    return df.withColumn("_group", key).join(totals, "_group").drop("_group")


def _position_between(value: Column, low: Column, high: Column, kind: T.DataType) -> Column:
    """Where a value lies between two bounds, from 0 to 1; never falls as the value grows."""
    if isinstance(kind, T.FractionalType) and not isinstance(kind, T.DecimalType):
        # halves, so that the distance of two doubles stays finite
        value, low, high = (c.cast("double") / 2 for c in (value, low, high))
        return (value - low) / (high - low)
    if isinstance(kind, T.IntegralType):
        value, low, high = (c.cast("decimal(20,0)") for c in (value, low, high))
    return (value - low).cast("double") / (high - low).cast("double")


def select_positions(rows: DataFrame, wanted: DataFrame, kind: T.DataType) -> DataFrame:
    """Values at the wanted positions (from 0) of each group's ascending values.

    ``rows`` has (_group, _v), ``wanted`` (_group, _at, _lo, _hi): positions, and the least and largest value of
    the group.  The result is (_group, _at, _v).

    The interval that holds a position is counted in ``CELLS`` equal ranges by one
    aggregation that combines before its shuffle; the range that holds it, with its own least and
    largest value, is the next interval.  The ends of an interval never share a range, so
    every round narrows it, for decimals at least by ``CELLS``: three rounds for amounts up to
    hundreds of millions in cents.  Only counts are shuffled, and a group may be of any size.
    """
    open_ = wanted.withColumn("_skip", F.lit(0).cast("long"))
    done: list[DataFrame] = []
    key = ["_group", "_lo", "_hi"]
    while True:
        open_ = stash(open_, "percentile-intervals")
        done.append(open_.where("_lo = _hi").select("_group", "_at", F.col("_lo").alias("_v")))
        open_ = open_.where("_lo < _hi")
        if not open_.limit(1).count():
            return reduce(DataFrame.unionByName, done)
        spans = open_.select(*key).distinct()
        inside = rows.join(spans, "_group").where("_v BETWEEN _lo AND _hi")
        share = _position_between(F.col("_v"), F.col("_lo"), F.col("_hi"), kind)
        cell = F.least(F.floor(share * CELLS), F.lit(CELLS - 1)).alias("_cell")
        cells = inside.groupBy(*key, cell).agg(
            F.count(F.lit(1)).alias("_n"), F.min("_v").alias("_least"), F.max("_v").alias("_most")
        )
        earlier = W.partitionBy(*key).orderBy("_cell").rowsBetween(*_BEFORE)  # CELLS rows at most
        cells = cells.withColumn("_below", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
        place = F.col("_at") - F.col("_skip") - F.col("_below")
        open_ = (
            open_.join(cells, key)
            .where((place >= 0) & (place < F.col("_n")))
            .select(
                "_group",
                "_at",
                F.col("_least").alias("_lo"),
                F.col("_most").alias("_hi"),
                (F.col("_skip") + F.col("_below")).alias("_skip"),
            )
        )


def exact_percentiles(
    df: DataFrame,
    groups: Sequence[str],
    value: str,
    points: dict[str, float],
    ties: Sequence[str] = (),
    discrete: bool = False,
) -> DataFrame:
    """Continuous percentiles per group, as DOUBLE, without ordering the rows.

    The one or two values around each percentile are selected by counting ranges and
    interpolated.  ``discrete`` takes the least value that at least that share of the values does
    not exceed.  NULL values are left out.  The frame is read once per round, so store it
    first if it is costly.  ``ties`` does not matter: equal values need no order.
    """
    rows = df.where(F.col(value).isNotNull()).select(
        _group_key(groups).alias("_group"), F.col(value).alias("_v")
    )
    bounds = rows.groupBy("_group").agg(
        F.count(F.lit(1)).alias("_of"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi")
    )
    bounds = stash(bounds, "percentile-bounds")
    targets = {name: F.lit(float(share)) * (F.col("_of") - 1) for name, share in points.items()}
    if discrete:
        upto = {name: F.ceil(F.lit(float(share)) * F.col("_of")) for name, share in points.items()}
        targets = {name: F.greatest(n - 1, F.lit(0)).cast("double") for name, n in upto.items()}
    places = [f(t) for t in targets.values() for f in (F.floor, F.ceil)]
    wanted = bounds.select("_group", "_lo", "_hi", F.explode(F.array_distinct(F.array(*places))).alias("_at"))
    found = select_positions(rows, wanted, df.schema[value].dataType)
    number = F.col("_v").cast("double")
    picks = []
    for name, target in targets.items():
        low = F.floor(target)
        picks += [
            F.max(F.when(F.col("_at") == low, number)).alias(f"_lo_{name}"),
            F.max(F.when(F.col("_at") == F.ceil(target), number)).alias(f"_hi_{name}"),
            F.max(target - low).alias(f"_part_{name}"),
        ]
    edges = found.join(bounds.select("_group", "_of"), "_group").groupBy("_group").agg(*picks)

    def between(name: str) -> Column:
        lo, hi, part = (F.col(f"_{p}_{name}") for p in ("lo", "hi", "part"))
        return (lo * (F.lit(1.0) - part) + hi * part).alias(name)

    return edges.select(*(F.col(f"_group.{g}").alias(g) for g in groups), *[between(n) for n in points])
