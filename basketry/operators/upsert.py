"""Keyed upsert, rolling reprocess window and incremental partition rewrite on parquet."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import month_start, subtract_days
from ..session import stash
from ..sources.tables import footer_bounds, laid_out, write_table
from .keymonths import in_months, months_of_keys, record_months

FEW_UPDATES = 2_000_000  # keys that every task can hold
FILTER_BITS = 1 << 26  # of a filter that every task can hold: a million words at most
MONTH_FILES, FILE_BYTES = 8, 16 * 2**20  # a month in more files than that, and smaller ones, is dealt anew


def _by_key(rows: DataFrame, updates: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Semi or anti join with the keys of ``updates``; NULL key parts are equal."""
    named = updates.select(*(F.col(k).alias(f"_key_{i}") for i, k in enumerate(keys)))
    same = [F.col(k).eqNullSafe(F.col(f"_key_{i}")) for i, k in enumerate(keys)]
    return rows.join(named, same, how)


def upsert(target: DataFrame, updates: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``target`` whose key is not updated, plus all ``updates`` (one row per key)."""
    return _by_key(target, updates, keys, "left_anti").unionByName(updates)


def refuse_repeated_keys(updates: DataFrame, keys: Sequence[str]) -> None:
    """Raise if two rows of ``updates`` have one key: which of them should win is unknown."""
    repeated = updates.groupBy(*keys).count().where("count > 1").first()
    if repeated is not None:
        raise ValueError(f"several updates for one key: {repeated.asDict()}")


def window_floor(
    target: DataFrame | None, date: str, days: int = 14, path: str | None = None
) -> Column | None:
    """First date to reprocess; None when there is no target row, meaning everything.

    One value is read from the target, so the filter holds a literal that is pushed down to
    the scan and prunes partitions.  With the ``path`` of a stored target it comes from the
    footers of the files.
    """
    if target is not None and path is not None:
        last = footer_bounds(target.sparkSession, path, date).first()["most"]
    else:
        last = target.agg(F.max(date)).first()[0] if target is not None else None
    return None if last is None else subtract_days(F.lit(last), days)


def reprocess_window(
    source: DataFrame, target: DataFrame | None, date: str, days: int = 14
) -> DataFrame:
    """Source rows dated at most ``days`` before the newest target row."""
    floor = window_floor(target, date, days)
    return source if floor is None else source.where(F.col(date) >= floor)


def stored_table(spark: SparkSession, path: str) -> DataFrame | None:
    """The table at ``path``, or None when nothing has been stored there yet."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        missing = {"PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"}
        if error.getCondition() in missing:
            return None
        raise


def within_key_range(df: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Rows whose key lies between the smallest and largest key of ``keys``.

    Drops only rows that cannot match.  The two bounds are literals, so the scan skips the
    files and row groups outside them; ids that grow over time make that most of a table.
    """
    low, high, nulls = keys.agg(F.min(key), F.max(key), F.count_if(F.col(key).isNull())).first()
    inside = F.lit(False) if low is None else F.col(key).between(low, high)
    if nulls:
        inside = inside | F.col(key).isNull()
    return df.limit(0) if low is None and not nulls else df.where(inside)


def few_keys(keys: DataFrame) -> bool:
    """Whether every task can hold these keys, so that what is joined with them need not be shuffled."""
    return keys.limit(FEW_UPDATES + 1).count() <= FEW_UPDATES


def perhaps_among(rows: DataFrame, keys: DataFrame, key: str, flag: str) -> DataFrame:
    """``rows`` with a column ``flag``: true where the key is among ``keys``, and for few other rows.

    For keys that are too many to be broadcast.  Each is hashed to a bit, and the words of these bits are
    broadcast, so that an exact join has little more to shuffle than what it finds.  With keys by the hundred
    million the flag is mostly true and saves nothing.  So it does where the keys differ in type.
    """
    kind = rows.schema[key].dataType
    if keys.schema[key].dataType != kind or not isinstance(kind, (T.IntegralType, T.StringType, T.BinaryType)):
        return rows.withColumn(flag, F.lit(True))
    spot = F.pmod(F.xxhash64(key), F.lit(FILTER_BITS)).alias("_spot")
    bit = F.bit_or(F.expr("shiftleft(1L, CAST(_spot & 63L AS INT))")).alias("_bits")
    words = keys.select(spot).groupBy(F.shiftright("_spot", 6).alias("_word")).agg(bit)
    found = rows.select("*", spot).join(F.broadcast(words), F.shiftright("_spot", 6) == F.col("_word"), "left")
    is_set = F.getbit("_bits", F.expr("CAST(_spot & 63L AS INT)")) == 1
    return found.withColumn(flag, F.coalesce(is_set, F.lit(False))).drop("_spot", "_word", "_bits")


def near_keys(rows: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """The rows whose key is among ``keys``, and few others: see ``perhaps_among``."""
    return perhaps_among(rows, keys, key, "_near").where("_near").drop("_near")


def rows_of_keys(rows: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Semi join with stored keys that shuffles few of the rows."""
    if few_keys(keys):
        return rows.join(F.broadcast(keys), key, "left_semi")
    return near_keys(rows, keys, key).join(keys, key, "left_semi")


def rows_without_keys(rows: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Anti join with stored keys that shuffles few of the rows."""
    if few_keys(keys):
        return rows.join(F.broadcast(keys), key, "left_anti")
    marked = perhaps_among(rows, keys, key, "_near")
    near, far = marked.where("_near").drop("_near"), marked.where("NOT _near").drop("_near")
    return far.unionByName(near.join(keys, key, "left_anti").select(*far.columns))


def small_files(target: DataFrame, month: str, months: set) -> set:
    """Those of the months that lie in more than ``MONTH_FILES`` files of less than ``FILE_BYTES`` on average."""
    files = target.select(F.col(month).cast("date").alias("m"), "_metadata.file_path", "_metadata.file_size")
    sizes = files.where(in_months("m", months)).distinct().groupBy("m").agg(F.count(F.lit(1)).alias("files"), F.avg("file_size").alias("bytes"))
    found = sizes.where((F.col("files") > MONTH_FILES) & (F.col("bytes") < FILE_BYTES))
    return {r["m"] for r in found.collect()}


def merged_months(
    target: DataFrame,
    updates: DataFrame,
    keys: Sequence[str],
    month: str,
    months: set,
    sort_by: Sequence[str],
    keep: Callable[[DataFrame], DataFrame] = lambda kept: kept,
) -> DataFrame:
    """The rows of ``months`` after the merge, arranged for writing by month.

    Rows that stay already lie in files of their month.  Unless there are so many updates that finding
    them shuffles the table anyway, they are written in the tasks that read them, and only
    the updates are dealt by month.  A month that many merges have left in many small files is dealt
    anew.  ``keep`` stores the rows that stay.
    """
    affected = target.withColumn(month, F.col(month).cast("date")).where(in_months(month, months))
    named = updates.select(*keys)
    if not few_keys(updates):
        kept = keep(_by_key(affected, named, keys, "left_anti"))
        return laid_out(kept.unionByName(updates), [month], sort_by)
    kept = keep(_by_key(affected, F.broadcast(named), keys, "left_anti"))
    again = small_files(target, month, months)
    dealt = kept.where(in_months(month, again)).unionByName(updates) if again else updates
    stay = kept.where(in_months(month, months - again))
    rows = stay.unionByName(dealt.hint("rebalance", F.col(month)))
    return rows.sortWithinPartitions(month, *[c for c in sort_by if c != month])


def stored_rows_of(target: DataFrame, updates: DataFrame, keys: Sequence[str], month: str, root: str) -> DataFrame:
    """Keys and month of the target's rows that ``updates`` replaces.

    The stored map from keys to months says which months can hold them; only those are read.
    Without a map (a table written by other means) the range of the keys bounds the scan.
    """
    months = months_of_keys(target.sparkSession, root, updates, keys[0])
    rows = target.select(*keys, month)
    near = within_key_range(rows, updates, keys[0]) if months is None else rows.where(in_months(month, months))
    return _by_key(near, updates, keys, "left_semi")


def write_incremental(
    updates: DataFrame,
    path: str,
    keys: Sequence[str],
    date: str,
    month: str = "order_month",
    sort_by: Sequence[str] = (),
) -> DataFrame:
    """Merge ``updates`` by key into a table partitioned by the month of ``date``.

    Only months that gain or lose a row are rewritten, with dynamic partition overwrite:
    the months of the updates, and the months the updated keys were stored under before.
    The updates are stored first, so every step sees the same rows while the target changes.
    A repeated call with the same updates leaves the same table, NULL key parts included; several
    updates for one key raise.
    """
    spark = updates.sparkSession
    updates = stash(updates.withColumn(month, month_start(date)), "updates")
    refuse_repeated_keys(updates, keys)
    # the keys come last, so rows that agree on ``sort_by`` can still be spread
    layout = list(dict.fromkeys([*sort_by, *keys]))
    there = stored_table(spark, path)
    if there is None:
        table = write_table(updates, path, partition_by=month, sort_by=layout)
        record_months(updates, None, path, keys[0], month)
        return table

    target = there.withColumn(month, F.col(month).cast("date"))
    old = stored_rows_of(target, updates, keys, month, path)
    touched = updates.select(month, F.lit(True).alias("gains")).unionByName(
        old.select(month, F.lit(False).alias("gains"))
    )
    # one row per touched partition of the table, so a short list
    found = touched.distinct().collect()
    gaining = {r[month] for r in found if r["gains"]}
    losing = {r[month] for r in found if not r["gains"]}
    left_over = losing - gaining
    if left_over:
        # a month all of whose rows moved away gets no new files, so clear it by hand below
        kept = _by_key(target.where(in_months(month, left_over)), updates, keys, "left_anti")
        left_over -= {r[0] for r in kept.select(month).distinct().collect()}

    record_months(updates, target, path, keys[0], month)
    # stored before anything is replaced: a failure below leaves a whole copy to go on from
    merged = merged_months(there, updates, keys, month, gaining | losing, layout, lambda kept: stash(kept, "kept"))
    (
        merged.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(month)
        .parquet(path)
    )
    for value in left_over:
        name = "__HIVE_DEFAULT_PARTITION__" if value is None else value.isoformat()
        nothing = updates.drop(month).limit(0)
        nothing.write.mode("overwrite").parquet(f"{path}/{month}={name}")
    spark.catalog.refreshByPath(path)
    return spark.read.parquet(path)
