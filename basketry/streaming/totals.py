"""Daily totals of arriving events, added up over batches, runs and streams."""

from __future__ import annotations

from concurrent.futures import Future

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..session import remove_folder, subfolders

COMPACT_EVERY = 10
SCHEMA = "event_date date, event_type string, event_count long, total_value decimal(28,2)"


def _numbers(spark: SparkSession, folder: str) -> list[int]:
    return sorted(int(name.split("=")[1]) for name in subfolders(spark, folder))


def _parts(spark: SparkSession, path: str, stream: str) -> list[tuple[int, int]]:
    """(first, last) batch of each stored part of a stream."""
    folder = f"{path}/{stream}"
    return [(a, b) for a in _numbers(spark, folder) for b in _numbers(spark, f"{folder}/first={a}")]


def _counted(parts: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The parts that hold each batch once: the longest from batch 0 on, and the later ones."""
    upto = max((b for a, b in parts if a == 0), default=-1)
    return [(a, b) for a, b in parts if (a == 0 and b == upto) or a > upto]


def _folder(path: str, stream: str, part: tuple[int, int]) -> str:
    return f"{path}/{stream}/first={part[0]}/last={part[1]}"


def _write(totals: DataFrame, folder: str) -> None:
    # a row per day and type, so one file, which readers see whole or not at all
    totals.coalesce(1).write.mode("overwrite").parquet(folder)


def _added_up(totals: DataFrame) -> DataFrame:
    return totals.groupBy("event_date", "event_type").agg(
        F.sum("event_count").alias("event_count"),
        F.sum("total_value").cast("decimal(28,2)").alias("total_value"),
    )


def _fold(spark: SparkSession, path: str, stream: str, upto: int) -> None:
    """Put the batches up to number ``upto`` together in one part."""
    parts = [(a, b) for a, b in _counted(_parts(spark, path, stream)) if b <= upto]
    if len(parts) > 1:
        folders = [_folder(path, stream, p) for p in parts]
        _write(_added_up(spark.read.schema(SCHEMA).parquet(*folders)), _folder(path, stream, (0, upto)))


def _drop_folded(spark: SparkSession, path: str, stream: str, upto: int) -> None:
    """Remove the parts that lie in the one from batch 0 to ``upto``."""
    for part in _parts(spark, path, stream):
        if part[1] <= upto and part != (0, upto):
            remove_folder(spark, _folder(path, stream, part))


def daily_revenue_stream(
    events: DataFrame, path: str, checkpoint: str, compact_every: int = COMPACT_EVERY
) -> StreamingQuery:
    """Event value per day and type, however late an event is.

    Counts and sums add up, so no state is kept between batches: each batch writes its own totals
    below ``path``, in a folder of the stream's id (which Spark keeps in the checkpoint) and of
    its number, and ``daily_revenue`` adds them up.  A batch that is replayed replaces its own
    totals only; streams and runs with other checkpoints add theirs.

    A batch begins when those before it have been committed, so every ``compact_every`` batches they are
    put together in one part.  What that part replaces is removed one such step later, so that
    readers that have just begun still find it.
    """
    amount = F.col("value").cast("decimal(18,2)")
    spark = events.sparkSession
    started: Future[str] = Future()

    def add(batch: DataFrame, number: int) -> None:
        stream = f"stream={started.result()}"
        if number and number % compact_every == 0:
            before = max((b for a, b in _parts(spark, path, stream) if a == 0 and b < number), default=-1)
            _fold(spark, path, stream, number - 1)
            _drop_folded(spark, path, stream, before)
        day = F.col("ts").cast("timestamp").cast("date").alias("event_date")
        totals = batch.groupBy(day, "event_type").agg(
            F.count(F.lit(1)).alias("event_count"), F.sum(amount).alias("total_value")
        )
        _write(totals, _folder(path, stream, (number, number)))

    query = (
        events.writeStream.foreachBatch(add)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    started.set_result(query.id)
    return query


def compact_daily_revenue(spark: SparkSession, path: str) -> None:
    """Leave two parts of each stream: the newest batch, which may be replayed, and all before it.

    For a time when no stream writes and no reader reads; may be repeated after a failure.
    """
    for stream in subfolders(spark, path):
        parts = _counted(_parts(spark, path, stream))
        upto = max((b for _, b in parts), default=0) - 1
        if upto >= 0:
            _fold(spark, path, stream, upto)
            _drop_folded(spark, path, stream, upto)


def daily_revenue(spark: SparkSession, path: str) -> DataFrame:
    """Totals of all batches of all streams below ``path``; no rows before the first one."""
    folders = [
        _folder(path, stream, part)
        for stream in subfolders(spark, path)
        for part in _counted(_parts(spark, path, stream))
    ]
    if not folders:
        return spark.createDataFrame([], SCHEMA)
    return _added_up(spark.read.schema(SCHEMA).parquet(*folders))
