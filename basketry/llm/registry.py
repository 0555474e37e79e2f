"""Registered queries of the training-data operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import fresh_path, stash
from . import oracle
from .bpe import round_trip_digests
from .decontaminate import decontaminate
from .language import fit_language
from .minhash import near_duplicates
from .mixing import mix_sources, word_count
from .sharding import shard
from .spelling import count_words, spelling_variants
from .suffixes import remove_repeats
from .tokens import token_positions, write_token_ids
from .toxicity import MAX_ROWS, ToxicityModel, fit_toxicity
from .urls import Rule, judge_urls
from .vectors import near_vectors
from .whitening import whiten

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = oracle.SQL


def query(f):
    QUERIES[f.__name__] = f
    return f


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def held_out(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2


def document_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Weight of each labelled document: good ones count twice, poor ones half."""
    labels = table(spark, folder, "labels").groupBy("doc_id").agg(F.max("quality").alias("_q"))
    weight = F.when(F.col("_q") == 1, 2.0).when(F.col("_q") == 0, 0.5)
    return labels.select("doc_id", weight.alias("_weight"))


def toxicity_model(spark: SparkSession, docs: DataFrame, folder: str) -> ToxicityModel:
    """Fitted on labelled documents that are not held out.

    The labels are drawn first, at most ``MAX_ROWS`` by the hash of their document's id.  So few are
    broadcast, and no text is shuffled.
    """
    labels = table(spark, folder, "labels").select("doc_id", F.col("toxic").alias("label"))
    labels = labels.where(~held_out(F.col("doc_id"))).where("label in (0, 1)").distinct()
    drawn = labels.orderBy(F.xxhash64("doc_id", F.lit(11)), "doc_id", "label").limit(MAX_ROWS)
    learned = docs.select("doc_id", "text").join(F.broadcast(stash(drawn, "toxicity-labels")), "doc_id")
    return fit_toxicity(learned, by="doc_id")


@query
def op1_toxicity(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text")
    scored = toxicity_model(spark, docs, folder).score(docs)
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


@query
def op2_language(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang")
    model = fit_language(docs.where(~held_out(F.col("doc_id"))), by="doc_id")
    found = model.predict(docs.select("doc_id", "text"))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


URL_RULES = [
    Rule("com", "/", "allow"),
    Rule("example.com", "/en/", "block"),
    Rule("www.example.com", "/en/", "allow"),
    Rule("net", "/es/", "block"),
    Rule("net", "/fr/", "block"),
]


@query
def op3_url_templates(spark, folder):
    pages = table(spark, folder, "pages").select("page_id", "url")
    return judge_urls(pages, URL_RULES).drop("url")


@query
def op4_repeated_passages(spark, folder):
    cleaned = remove_repeats(table(spark, folder, "documents"))
    gone = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s.end - s.start)
    return cleaned.select(
        F.col("id").alias("doc_id"),
        "n_bytes",
        gone.alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


@query
def op5_near_duplicates(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return near_duplicates(docs).select("doc_id", "class_id", "kept")


@query
def op6_near_vectors(spark, folder):
    vectors = table(spark, folder, "embeddings").select("vec_id", "embedding", "label")
    return near_vectors(vectors).select("vec_id", "n_links", "component_id", "kept")


@query
def op7_mix_sources(spark, folder):
    docs = table(spark, folder, "documents")
    docs = docs.select("doc_id", "source", word_count(F.col("text")).alias("n"))
    docs = stash(docs, "mix-sizes").join(document_quality(spark, folder), "doc_id", "left")
    mixed = mix_sources(docs, F.col("n"), quality=F.col("_weight"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


@query
def op8_token_orc(spark, folder):
    import public_tokenizers

    docs = table(spark, folder, "documents")
    path = fresh_path(spark, "token-ids")
    write_token_ids(docs, path, public_tokenizers.path("word_bpe_49k.json"))
    return token_positions(spark, path, docs.schema["doc_id"].dataType).withColumnRenamed("id", "doc_id")


@query
def op9_decontaminate(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text")
    marked = decontaminate(docs, table(spark, folder, "benchmark"))
    c = F.col("contamination")
    hit = F.aggregate(c.spans, F.lit(0).cast("long"), lambda n, s: n + s.end - s.start)
    return marked.select("doc_id", c.n_words.alias("n_words"), hit.alias("n_hit"), c["items"].alias("items")).select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


@query
def op10_shard(spark, folder):
    docs = table(spark, folder, "documents")
    docs = docs.select("doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"))
    return shard(docs, F.col("n_bytes"))


@query
def op11_spelling_variants(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return spelling_variants(count_words(docs, drop_every=97))


@query
def op12_byte_bpe(spark, folder):
    import public_tokenizers

    docs = table(spark, folder, "documents").select("doc_id", "text")
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return round_trip_digests(docs, f"file://{ranks}").withColumnRenamed("id", "doc_id")


@query
def op13_whitening(spark, folder):
    vectors = table(spark, folder, "embeddings").select("vec_id", "embedding")
    return whiten(vectors).withColumnRenamed("id", "vec_id")
