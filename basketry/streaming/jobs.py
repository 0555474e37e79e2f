"""Structured Streaming jobs over arriving files."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..plans.refresh import match_returns, refresh_fct_orders
from ..relations import Relations
from ..session import freed_stashes, remove_folder, stash, subfolders


def _orders_of_batch(batch: DataFrame, number: int, items: DataFrame, waiting: str) -> DataFrame:
    """Ids of the orders of a batch of returns and of the returns that still wait for their line.

    Batch ``n`` takes what the batch before it left waiting and leaves a folder of its own, so a
    replayed batch starts from the same state.  The folder before the last is removed.
    """
    spark = batch.sparkSession
    left = sorted(int(name.split("=")[1]) for name in subfolders(spark, waiting))
    earlier = [n for n in left if n < number]
    named = batch.select("order_item_id")
    if earlier:
        named = named.unionByName(spark.read.schema(named.schema).parquet(f"{waiting}/batch={earlier[-1]}"))
    orders, unmatched = match_returns(named, items)
    unmatched.write.mode("overwrite").parquet(f"{waiting}/batch={number}")
    for old in earlier[:-1]:
        remove_folder(spark, f"{waiting}/batch={old}")
    return orders


def refresh_fct_orders_stream(
    arriving: DataFrame,
    path: str,
    checkpoint: str,
    staged: Relations | Callable[[], Relations],
    customers: DataFrame | Callable[[], DataFrame],
    days: int = 14,
    waiting: str | None = None,
) -> StreamingQuery:
    """Refresh the fact table for each batch of arriving orders or returns.

    ``arriving`` is a stream with ``order_id`` (orders) or ``order_item_id`` (returns).  It
    only says which orders to rebuild; their rows come from the staged relations.  The
    merge is keyed, so a batch that is replayed after a failure changes nothing.  The
    rolling window stays a batch filter: it is bound by the target, not by the stream.
    Pass ``staged`` and ``customers`` as functions to read them anew for each batch.

    A return can come before its order line.  It then waits in a folder (``waiting``, beside the
    checkpoint by default), and every later batch looks for its line again.

    What a batch stores on its way is deleted when the batch has been merged.
    """
    spark = arriving.sparkSession
    waiting = waiting or f"{checkpoint}-waiting"

    def merge(batch: DataFrame, number: int) -> None:
        now = staged() if callable(staged) else staged
        dim = customers() if callable(customers) else customers
        with freed_stashes(spark):
            if "order_id" in batch.columns:
                ids = batch.select("order_id")
            else:
                ids = _orders_of_batch(batch, number, now.order_items, waiting)
            refresh_fct_orders(path, now, dim, days, changed_order_ids=stash(ids, "changed-orders"))

    return (
        arriving.writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def event_stream(spark: SparkSession, folder: str, pattern: str, files_per_batch: int = 100):
    """Stream of parquet files in ``folder`` whose names match ``pattern``."""
    schema = spark.read.parquet(f"{folder}/{pattern}").schema
    return (
        spark.readStream.schema(schema)
        .option("pathGlobFilter", pattern)
        .option("maxFilesPerTrigger", files_per_batch)
        .parquet(folder)
    )
