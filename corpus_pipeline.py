"""Corpus pipeline: from raw documents to shards of a clean, mixed corpus.

Each stage takes (spark, docs, sf_dir), works on all rows of its predecessor, and returns the
columns of ``documents``; the last one adds the shard.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.llm import registry
from basketry.llm.decontaminate import decontaminate
from basketry.llm.minhash import near_duplicates
from basketry.llm.mixing import mix_sources, word_count
from basketry.llm.sharding import shard
from basketry.session import stash


def _documents(df: DataFrame, docs: DataFrame) -> DataFrame:
    return df.select(*(f"`{c}`" for c in docs.columns))


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the model does not reject, whatever their label says."""
    model = registry.toxicity_model(spark, docs, sf_dir)
    return _documents(model.score(docs).where("predicted = 0"), docs)


def near_duplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each class of near copies, of the least id."""
    return _documents(near_duplicates(docs).where("kept"), docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark item."""
    marked = decontaminate(docs, registry.table(spark, sf_dir, "benchmark"))
    return _documents(marked.where(F.size("contamination.spans") == 0), docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """As many copies of each document as the mix takes, none included."""
    quality = registry.document_quality(spark, sf_dir)
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_doc")
    sized = docs.select(row, "doc_id", "source", word_count(F.col("text")).alias("_n"))
    sized = stash(sized.join(quality, "doc_id", "left"), "mix-sizes")
    mixed = mix_sources(sized, F.col("_n"), quality=F.col("_weight")).where("copies > 0")
    taken = mixed.select("_doc", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("_copy"))
    return taken.select("_doc.*")


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return shard(docs, F.octet_length("text"))


STAGES = [
    ("toxicity", toxicity),
    ("near_duplicates", near_duplicate),
    ("decontamination", decontamination),
    ("mixing", mixing),
    ("sharding", sharding),
]

#: Learned scores and sampled signatures have no SQL; tests/llm holds the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stash(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
