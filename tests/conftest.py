import datetime as dt
import sys
from decimal import Decimal
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from basketry.session import get_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = get_session(
        "basketry-tests",
        **{
            "spark.master": "local[8]",
            "spark.sql.shuffle.partitions": "8",
            "spark.driver.memory": "8g",
            "spark.python.sql.dataFrameDebugging.enabled": "false",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def many_chunks(spark, monkeypatch):
    """Keep small data spread over several range partitions, as large data would be."""
    monkeypatch.setattr("basketry.operators.ordered.LEAST_CHUNK_ROWS", 5)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def day(text):
    return dt.date.fromisoformat(text)


def money(text):
    return Decimal(text)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: [(x is None, str(x)) for x in r])
