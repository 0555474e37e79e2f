"""Near-duplicate vectors by a forest of random-projection trees with spill."""

from __future__ import annotations

import pickle
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import stash
from .components import components
from .rows import pack, unpack

THRESHOLD = 0.93
TREES = 8
SPILL = 0.05  # of a node's vectors on either side of the median go both ways
SAMPLE = 20_000  # vectors that the splits near the roots are fitted on, shared out by group size
SAMPLE_BYTES = 16 << 20  # of one (label, length)
GROUP_SAMPLE = 128  # vectors at least for a (label, length) of more than LEAF
LEAST_SAMPLE = 16  # a node with fewer sampled vectors is not split by the fitted trees
LEAF = 512  # a leaf with more is split further in its task
SMALL_LEAF = 32  # likewise, in trees of a (label, length) of up to LEAF vectors
BLOCK = 1024


def _valid(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Replace vectors by their bytes in double precision; invalid ones become null."""
    for batch in batches:
        out = []
        for v in batch.column(0).to_pylist():
            x = np.array(v, np.float64) if v is not None and None not in v else np.zeros(0)
            # a subnormal scale would lose digits in the norm
            good = len(x) and np.isfinite(x).all() and (top := np.abs(x).max()) > 0
            out.append((x / top).tobytes() if good else None)
        yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary()), batch.column(1)], ["v", "row"])


def _matrix(column) -> np.ndarray:
    x = np.stack([np.frombuffer(v, np.float64) for v in column])
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _split(x: np.ndarray, rng: np.random.Generator, spill: float):
    """A random direction through two vectors' difference, and the bounds of both sides."""
    a, b = rng.choice(len(x), 2, replace=False)
    direction = x[a] - x[b]
    if not direction.any():
        direction = rng.standard_normal(x.shape[1])
    at = x @ direction
    low, high = np.quantile(at, [0.5 - spill, 0.5 + spill])
    return direction, low, high


def _fit(x: np.ndarray, rng: np.random.Generator) -> list:
    """Nodes (direction, low, high, left, right); a child below 0 is a leaf."""
    nodes: list = []

    def grow(rows: np.ndarray) -> int:
        if len(rows) < 2 * LEAST_SAMPLE:
            return -1
        direction, low, high = _split(x[rows], rng, SPILL)
        at = x[rows] @ direction
        left, right = rows[at <= high], rows[at >= low]
        if max(len(left), len(right)) > 0.9 * len(rows):
            return -1
        place = len(nodes)
        nodes.append(None)
        nodes[place] = (direction, low, high, grow(left), grow(right))
        return place

    grow(np.arange(len(x)))
    return nodes


def _leaves(nodes: list, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, leaf) of each vector in each leaf that it reaches."""
    if not nodes:
        return np.arange(len(x)), np.zeros(len(x), np.int64)
    found: list[tuple[np.ndarray, int]] = []
    todo = [(0, np.arange(len(x)))]
    while todo:
        place, rows = todo.pop()
        direction, low, high, *children = nodes[place]
        at = x[rows] @ direction
        for side, (child, own) in enumerate(zip(children, (rows[at <= high], rows[at >= low]), strict=True)):
            if child >= 0:
                todo.append((child, own))
            else:
                found.append((own, 2 * place + side + 1))
    return np.concatenate([r for r, _ in found]), np.concatenate([np.full(len(r), leaf) for r, leaf in found])


def _assign(forest):
    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            frame = batch.to_pandas()
            for label, own in frame.groupby("label", sort=False):
                for dim, same in own.groupby(own["v"].str.len(), sort=False):
                    x = _matrix(same["v"])
                    # the trees of a (label, length) of up to LEAF vectors grow in the task that compares it
                    trees = forest.value.get((label, int(dim)))
                    for t, nodes in enumerate(trees) if trees else [(-1, [])]:
                        rows, leaf = _leaves(nodes, x)
                        part = same.iloc[rows]
                        out = pd.DataFrame({"label": label, "dim": int(dim), "tree": t, "leaf": leaf, "key": part["key"], "v": part["v"]})
                        yield pa.RecordBatch.from_pandas(out, _LEAF_ROWS, preserve_index=False)

    return assign


_LEAF_ROWS = pa.schema([("label", pa.string()), ("dim", pa.int32()), ("tree", pa.int32()), ("leaf", pa.int64()), ("key", pa.string()), ("v", pa.binary())])


def _seed(label: str, *numbers: int) -> list[int]:
    return [zlib.crc32(label.encode()), *map(int, numbers)]


def _compare(threshold: float):
    def pairs_of(x: np.ndarray, rows: np.ndarray, rng: np.random.Generator, out: list, most: int, tries: int = 8) -> None:
        if len(rows) > most and tries:
            direction, low, high = _split(x[rows], rng, SPILL)
            at = x[rows] @ direction
            left, right = rows[at <= high], rows[at >= low]
            if max(len(left), len(right)) <= 0.9 * len(rows):
                pairs_of(x, left, rng, out, most)
                pairs_of(x, right, rng, out, most)
            else:
                pairs_of(x, rows, rng, out, most, tries - 1)
            return
        for i in range(0, len(rows), BLOCK):
            for j in range(i, len(rows), BLOCK):
                a, b = np.nonzero(x[rows[i : i + BLOCK]] @ x[rows[j : j + BLOCK]].T >= threshold - 1e-9)
                a, b = rows[i + a], rows[j + b]
                out.append(np.stack([np.minimum(a, b), np.maximum(a, b)], 1)[a != b])

    def compare(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("key", ignore_index=True)
        x = _matrix(frame["v"])
        out: list[np.ndarray] = []
        label, dim, tree, leaf = frame.loc[0, ["label", "dim", "tree", "leaf"]]
        for t, most in [(tree, LEAF)] if tree >= 0 else [(t, SMALL_LEAF) for t in range(TREES)]:
            pairs_of(x, np.arange(len(x)), np.random.default_rng(_seed(label, dim, t, leaf)), out, most)
        pairs = np.unique(np.concatenate(out), axis=0)
        kept = [np.einsum("ij,ij->i", x[p[:, 0]], x[p[:, 1]]) >= threshold for p in np.array_split(pairs, len(pairs) // 100_000 + 1)]
        pairs = pairs[np.concatenate(kept)]
        keys = frame["key"].to_numpy()
        return pd.DataFrame({"a": keys[pairs[:, 0]], "b": keys[pairs[:, 1]]})

    return compare


def near_vectors(
    vectors: DataFrame,
    *,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    threshold: float = THRESHOLD,
    seed: int = 7,
) -> DataFrame:
    """All rows with ``n_links``, ``component_id`` and ``kept``.

    Vectors of one label and length whose cosine is ``threshold`` or more are linked.  Equal vectors (up to a
    positive factor) are one node with a weight, so copies are never paired with each other.
    A (label, length) of up to ``LEAF`` nodes meets in one task, which grows its ``TREES`` trees down to leaves of
    ``SMALL_LEAF``.  Splits of the others' trees are fitted on a uniform
    sample of their own: their part of ``SAMPLE`` nodes, ``GROUP_SAMPLE`` at least.  Every node is indexed: it
    goes down ``TREES`` trees, to both sides when near a split.  Nodes meet in leaves, where larger leaves are split on
    with the same spill, otherwise in each tree, blocks are multiplied, and pairs are verified in double precision.  Links of
    all leaves are united; components are found over them.

    Vectors that are null, empty, zero or hold null or non-finite components, and those with a null
    label, link with nothing and are their own component.  A null id counts as after all others;
    a component of null ids only has a null id and its rows are not kept.  Repeated rows are vectors of their own
    that link with each other.  Added columns take the place of columns of the same name.
    """
    spark = vectors.sparkSession
    named = pack(vectors, id=F.col(vec_id), label=F.col(label).cast("string"), raw=F.col(vector).cast("array<double>"))
    fields = [T.StructField("v", T.BinaryType())]
    given = named.select("raw", F.struct("_row", "id", "label").alias("row"))
    fields.append(T.StructField("row", given.schema["row"].dataType))
    rows = given.mapInArrow(_valid, T.StructType(fields)).select("row.*", "v")
    key = F.when(F.col("label").isNotNull() & F.col("v").isNotNull(), F.md5(F.concat(F.encode("label", "utf-8"), F.lit(b"\0"), "v")))
    rows = stash(rows.withColumn("key", key), "vectors")
    nodes = rows.where("key IS NOT NULL").groupBy("key").agg(
        F.first("label").alias("label"), F.first("v").alias("v"), F.min("id").alias("least"), F.count(F.lit(1)).alias("many")
    )
    nodes = stash(nodes, "vector-nodes")
    forest = spark.sparkContext.broadcast(_forest(nodes, seed))
    leaves = nodes.select("label", "key", "v").mapInArrow(_assign(forest), "label string, dim int, tree int, leaf long, key string, v binary")
    found = leaves.groupBy("label", "dim", "tree", "leaf").applyInPandas(_compare(threshold), "a string, b string")
    links = stash(found.distinct(), "vector-links")
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    weight = nodes.select(F.col("key").alias("b"), "many")
    linked = both.join(weight, "b").groupBy(F.col("a").alias("key")).agg(F.sum("many").alias("others"))
    of = components(links).withColumnRenamed("node", "key")
    nodes = nodes.join(linked, "key", "left").join(of, "key", "left")
    nodes = nodes.withColumn("component", F.coalesce("component", "key"))
    least = nodes.groupBy("component").agg(F.min("least").alias("component_id"))
    nodes = nodes.join(least, "component").select("key", "component_id", (F.col("many") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"))
    out = rows.join(stash(nodes, "vector-classes"), "key", "left")
    out = out.withColumns({"component_id": F.when(F.col("key").isNull(), F.col("id")).otherwise(F.col("component_id")), "n_links": F.coalesce("n_links", F.lit(0)).cast("long")})
    out = out.withColumn("kept", F.coalesce(F.col("id") == F.col("component_id"), F.lit(False)))
    return unpack(out, ["n_links", "component_id", "kept"])


def _forest(nodes: DataFrame, seed: int) -> dict:
    """Trees by (label, length), each fitted on a sample of its own of bounded size and bytes.

    What comes to the driver are the splits: at most one for ``LEAST_SAMPLE`` sampled vectors or so.
    """
    c = F.col
    sized = nodes.select("label", F.length("v").alias("dim"), "key", "v")
    groups = sized.groupBy("label", "dim").agg(F.count(F.lit(1)).alias("many"))
    total = groups.agg(F.sum("many")).first()[0] or 0
    groups = groups.where(c("many") > LEAF)
    share = c("many") * F.lit(min(1.0, SAMPLE / max(1, total)))
    wanted = F.greatest(F.least(share, F.floor(F.lit(SAMPLE_BYTES) / c("dim"))), F.lit(GROUP_SAMPLE))
    groups = stash(groups.select("label", "dim", (wanted / c("many")).alias("part")), "vector-groups")
    # keys are hashes: the low ones are a uniform sample, the same in every run
    low = F.conv(F.substring("key", 1, 13), 16, 10).cast("double") / F.lit(float(2**52))
    chosen = sized.join(groups, ["label", "dim"]).where(low < c("part"))

    def fit(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("key", ignore_index=True)
        label, dim = frame.loc[0, ["label", "dim"]]
        x = _matrix(frame["v"])
        trees = [_fit(x, np.random.default_rng([seed, *_seed(label, dim, t)])) for t in range(TREES)]
        return pd.DataFrame({"label": [label], "dim": [dim], "trees": [pickle.dumps(trees)]})

    fitted = chosen.select("label", "dim", "key", "v").groupBy("label", "dim").applyInPandas(fit, "label string, dim int, trees binary")
    return {(r["label"], r["dim"]): pickle.loads(r["trees"]) for r in fitted.collect()}
