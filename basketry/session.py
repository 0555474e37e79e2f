"""Session settings and the shared folder used for intermediate tables."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Runtime SQL settings every job here relies on.  ANSI mode keeps bad casts loud;
# the skew-join settings let AQE split a join partition that one hot key fills,
# even if that costs one more shuffle further up the plan.
SQL_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}

_local_dir: str | None = None
_scopes = threading.local()


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session."""
    for key, value in SQL_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def get_session(app: str = "basketry", **conf: str) -> SparkSession:
    """Build (or reuse) a session with the settings above and the UI off."""
    builder = SparkSession.builder.appName(app).config("spark.ui.enabled", "false")
    for key, value in {**SQL_SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder all executors can reach, taken from ``spark.checkpoint.dir``.

    Only a local-mode session may fall back to a folder on this machine; on a cluster
    an unset folder is an error, because other hosts could not read what is written.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    global _local_dir
    if _local_dir is None:
        _local_dir = tempfile.mkdtemp(prefix="basketry-")
        atexit.register(shutil.rmtree, _local_dir, ignore_errors=True)
    return _local_dir


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path under the shared folder that nothing has been written to yet."""
    app = spark.sparkContext.applicationId
    path = f"{shared_dir(spark)}/basketry-{app}/{label}-{uuid.uuid4().hex}"
    for scope in getattr(_scopes, "open", []):
        scope.append(path)
    return path


def _located(spark: SparkSession, path: str):
    """The path and its file system, as Spark's writers use them."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), where


def subfolders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in a folder, none if there is no such folder."""
    files, where = _located(spark, path)
    if not files.exists(where):
        return []
    return [f.getPath().getName() for f in files.listStatus(where) if f.isDirectory()]


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder with its files; a missing one does no harm."""
    files, where = _located(spark, path)
    files.delete(where, True)


@contextmanager
def freed_stashes(spark: SparkSession) -> Iterator[None]:
    """Delete what the block has stashed when it ends.

    For jobs that end with a stored table, such as one batch of a stream: no frame made
    inside may be used outside.
    """
    scope: list[str] = []
    _scopes.open = [*getattr(_scopes, "open", []), scope]
    try:
        yield
    finally:
        _scopes.open = _scopes.open[:-1]
        for path in scope:
            remove_folder(spark, path)


def stash(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Used where several consumers read one expensive frame.  The written copy survives
    lost executors, cuts the lineage, and still allows column pruning and pushdown.
    """
    spark = df.sparkSession
    path = fresh_path(spark, label)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
