"""Carry whole input rows beside working columns, so that no column names clash."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def pack(docs: DataFrame, **columns: Column) -> DataFrame:
    """The row as struct ``_row``, and the given columns."""
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_row")
    return docs.select(row, *(c.alias(n) for n, c in columns.items()))


def unpack(df: DataFrame, outputs: Sequence[str]) -> DataFrame:
    """The columns of ``_row`` and the outputs; an input column named as an output gives way."""
    taken = {n.lower() for n in outputs}
    names = [n for n in df.schema["_row"].dataType.names if n.lower() not in taken]
    return df.select(*(F.col("_row").getField(n).alias(n) for n in names), *outputs)
