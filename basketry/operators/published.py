"""Keyed merge into a catalog table whose months are published after they have been written."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import month_start
from ..session import remove_folder, stash, subfolders
from ..sources.tables import laid_out
from .keymonths import in_months, record_months
from .upsert import merged_months, refuse_repeated_keys, stored_rows_of

_VERSION = "version="
_NO_MONTH = "__HIVE_DEFAULT_PARTITION__"


def published_table(spark: SparkSession, table: str) -> DataFrame | None:
    """The rows readers see now, or None when the table has not been created."""
    return spark.table(table) if spark.catalog.tableExists(table) else None


def _spec(month: str, folder: str) -> str:
    value = folder.split("=", 1)[1]
    return f"(`{month}` = NULL)" if value == _NO_MONTH else f"(`{month}` = DATE '{value}')"


def _create(spark: SparkSession, table: str, rows: DataFrame, root: str, month: str) -> None:
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    # the table's own folder stays empty: every month has a place of its own
    spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet PARTITIONED BY (`{month}`) LOCATION '{root}/none'")


def _months(spark: SparkSession, table: str) -> set[str]:
    return {r[0] for r in spark.sql(f"SHOW PARTITIONS {table}").collect()}


def write_version(rows: DataFrame, root: str, month: str) -> str:
    """Write rows arranged by month as a new version, which no reader sees yet; its folder."""
    version = f"{root}/{_VERSION}{uuid.uuid4().hex}"
    rows.write.partitionBy(month).parquet(version)
    return version


def publish(spark: SparkSession, table: str, month: str, version: str, emptied: set[dt.date | None] = frozenset()) -> None:
    """Point the months of a version to it, and take away those that have no rows any more.

    One catalog statement switches a month, so a reader sees the month as it was or as it is
    now.  Publishing again changes nothing.
    """
    there = _months(spark, table)
    written = [name for name in subfolders(spark, version) if name.startswith(f"{month}=")]
    for name in sorted(written):
        where = f"'{version}/{name}'"
        if name in there:
            spark.sql(f"ALTER TABLE {table} PARTITION {_spec(month, name)} SET LOCATION {where}")
        else:
            spark.sql(f"ALTER TABLE {table} ADD PARTITION {_spec(month, name)} LOCATION {where}")
    for value in emptied:
        name = f"{month}={_NO_MONTH if value is None else value.isoformat()}"
        if name in there and name not in written:
            spark.sql(f"ALTER TABLE {table} DROP PARTITION {_spec(month, name)}")
    spark.catalog.refreshTable(table)


def merge_published(
    updates: DataFrame,
    table: str,
    root: str,
    keys: Sequence[str],
    date: str,
    month: str = "order_month",
    sort_by: Sequence[str] = (),
) -> DataFrame:
    """Merge ``updates`` by key into a catalog table of months stored below ``root``.

    The touched months are merged into a new version first.  Readers go on with the old files,
    which stay untouched; a failure up to here leaves the table as it was.  Then each month is
    switched by one statement.  A job that stops between two of them leaves some months old
    and some new; the same merge, run again, ends it.  What is no longer published
    stays on disk for readers that have begun, until ``drop_unpublished``.

    Repeated updates of a key raise; NULL key parts are equal.
    """
    spark = updates.sparkSession
    updates = updates.withColumn(month, month_start(date))
    layout = list(dict.fromkeys([*sort_by, *keys]))
    target = published_table(spark, table)
    if target is None or not _months(spark, table):
        # nobody sees a version before it is published, so its rows need no copy to be checked on
        version = write_version(laid_out(updates, [month], layout), root, month)
        updates = spark.read.schema(updates.schema).parquet(version)
        try:
            refuse_repeated_keys(updates, keys)
        except ValueError:
            remove_folder(spark, version)
            raise
        record_months(updates, None, root, keys[0], month)
        if target is None:
            _create(spark, table, updates, root, month)
        publish(spark, table, month, version)
        return spark.table(table)
    updates = stash(updates, "updates")
    refuse_repeated_keys(updates, keys)
    old = stored_rows_of(target, updates, keys, month, root)
    gaining = {r[0] for r in updates.select(month).distinct().collect()}
    losing = {r[0] for r in old.select(month).distinct().collect()}
    record_months(updates, target, root, keys[0], month)
    version = write_version(merged_months(target, updates, keys, month, gaining | losing, layout), root, month)
    publish(spark, table, month, version, losing - gaining)
    return spark.table(table)


def drop_unpublished(spark: SparkSession, table: str, root: str) -> None:
    """Delete the stored months that the table no longer points to.

    For a time when no merge runs and no reader has an older state of the table open.
    """
    kept = set()
    for name in _months(spark, table):
        month = name.split("=", 1)[0]
        told = spark.sql(f"DESCRIBE FORMATTED {table} PARTITION {_spec(month, name)}")
        # the first location is the partition's, the table's own may follow
        place = next(r[1] for r in told.where(F.col("col_name") == "Location").collect())
        kept.add(tuple(place.rstrip("/").split("/")[-2:]))
    for version in subfolders(spark, root):
        if not version.startswith(_VERSION):
            continue
        names = subfolders(spark, f"{root}/{version}")
        for name in names:
            if (version, name) not in kept:
                remove_folder(spark, f"{root}/{version}/{name}")
        if not any((version, name) in kept for name in names):
            remove_folder(spark, f"{root}/{version}")
