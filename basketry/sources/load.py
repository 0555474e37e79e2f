"""One load of raw CSV extracts: typed rows as parquet, records that do not fit set aside."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import MONEY
from ..session import stash
from .raw import RAW_COLUMNS, RawTables, source
from .tables import read_table

# Types of the raw columns that are not text; the first column of an extract is its key.
RAW_TYPES = {
    "users": {"user_id": "bigint", "signup_date": "date", "ingested_at": "timestamp"},
    "products": {"product_id": "bigint", "supplier_id": "bigint", "cost": MONEY, "ingested_at": "timestamp"},
    "orders": {
        "order_id": "bigint", "user_id": "bigint", "order_date": "date", "total_amount": MONEY,
        "ingested_at": "timestamp",
    },
    "order_items": {
        "order_item_id": "bigint", "order_id": "bigint", "product_id": "bigint", "quantity": "int",
        "price": MONEY, "ingested_at": "timestamp",
    },
    "returns": {
        "return_id": "bigint", "order_item_id": "bigint", "return_date": "date", "refund_amount": MONEY,
        "ingested_at": "timestamp",
    },
}
LINE_KEYS = {"order_item_id", "return_id"}
_BAD = "_bad_record"


@dataclass(frozen=True)
class Loaded:
    """What a load has stored: typed rows, rejected records with their reasons, and how many."""

    rows: DataFrame
    rejected: DataFrame
    row_count: int
    rejected_count: int


def _called(kind: str | T.DataType) -> str:
    return kind if isinstance(kind, str) else kind.typeName()


def _typed(text: Column, kind: str | T.DataType) -> Column:
    """The value of a type, NULL where the text is not one; dates as ISO or month/day/year."""
    if kind != "date":
        return text.try_cast(kind)
    slashed = text.rlike(r"^\d{1,2}/\d{1,2}/\d{4}$")
    by_month = F.try_to_timestamp(text, F.lit("M/d/yyyy")).cast("date")
    return F.when(slashed, by_month).otherwise(text.try_cast("date"))


def _checked(parsed: DataFrame, table: str, types: dict[str, str | T.DataType]) -> DataFrame:
    """Typed columns, and the reasons for which a record is rejected."""
    key = RAW_COLUMNS[table][0]
    reasons = [F.when(F.col(_BAD).isNotNull(), F.lit("record: wrong number of fields"))]
    columns = []
    for name in RAW_COLUMNS[table]:
        text = F.col(name)
        if name in types:
            text = F.nullif(F.trim(text), F.lit(""))
            value = _typed(text, types[name])
            wrong = text.isNotNull() & value.isNull() & F.col(_BAD).isNull()
            reasons.append(F.when(wrong, F.lit(f"{name}: no {_called(types[name])}")))
            text = value
        columns.append(text.alias(name))
    blank = F.nullif(F.trim(key), F.lit("")).isNull() & F.col(_BAD).isNull()
    reasons.append(F.when(blank, F.lit(f"{key}: missing")))
    written = F.to_csv(F.struct(*RAW_COLUMNS[table]))
    found = F.array_compact(F.array(*reasons))
    return parsed.select(
        *columns,
        found.alias("_reasons"),
        F.when(F.size(found) > 0, F.coalesce(_BAD, written)).alias("_record"),  # good records need no copy
        F.col("_file"),
    )


def load_raw(
    spark: SparkSession,
    folder: str,
    table: str,
    out: str,
    *,
    prefix: str = "raw_",
    header: bool = True,
    line_key: str = "bigint",
) -> Loaded:
    """Parse one extract once and store it under ``out``: ``raw_<table>`` and ``rejected_<table>``.

    Fields are quoted text, lines end with LF or CRLF.  A record is rejected if it has too few or too many fields,
    if a field is not of its column's type, or if its key is missing; blank fields are NULL.  A
    rejected record keeps its text, the name of its file, and all reasons.  Both counts are observed while
    the records are written, so they cost no pass.  A header with other names is an error.
    """
    types = {c: line_key if c in LINE_KEYS else t for c, t in RAW_TYPES[table].items()}
    fields = [T.StructField(c, T.StringType()) for c in [*RAW_COLUMNS[table], _BAD]]
    parsed = (
        spark.read.schema(T.StructType(fields))
        .option("header", header)
        .option("quote", '"')
        .option("escape", '"')
        .option("enforceSchema", False)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", _BAD)
        .csv(f"{folder}/{prefix}{table}.csv")
    ).select("*", F.col("_metadata.file_name").alias("_file"))
    is_bad = F.size("_reasons") > 0
    seen = Observation(f"load {table}")
    counts = [F.count_if(~is_bad).alias("rows"), F.count_if(is_bad).alias("rejected")]
    checked = stash(_checked(parsed, table, types).observe(seen, *counts), f"checked-{table}")
    checked.where(~is_bad).select(*RAW_COLUMNS[table]).write.mode("overwrite").option(
        "compression", "zstd"
    ).parquet(f"{out}/raw_{table}")
    rejected = checked.where(is_bad).select(
        F.col(RAW_COLUMNS[table][0]).cast("string").alias("record_key"),
        F.col("_reasons").alias("reasons"),
        F.col("_record").alias("record"),
        F.col("_file").alias("file"),
    )
    rejected.write.mode("overwrite").parquet(f"{out}/rejected_{table}")
    found = seen.get
    return Loaded(
        source(spark, table, out), read_table(spark, f"{out}/rejected_{table}"), found["rows"], found["rejected"]
    )


def load_extracts(
    spark: SparkSession, folder: str, out: str, *, prefix: str = "raw_", line_key: str = "bigint"
) -> tuple[RawTables, dict[str, Loaded]]:
    """Load all five extracts; the raw relations read what was stored, not the text again."""
    loads = {t: load_raw(spark, folder, t, out, prefix=prefix, line_key=line_key) for t in RAW_COLUMNS}
    tables = RawTables(line_key, **{t: (lambda t=t: source(spark, t, out)) for t in RAW_COLUMNS})
    return tables, loads
