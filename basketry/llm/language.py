"""Language identification: family first, then one-versus-one linear SVMs within the family."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.classification import LinearSVC
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stash
from .rows import pack, unpack
from .text import mix, slices

MAX_PER_LANGUAGE = 1_500
BINS = 2048
UNKNOWN = "und"
LEARN_TASKS = 4

# Families of common languages by ISO 639-1 code; others are a family each.
FAMILIES = {
    "germanic": "en de nl sv da no nb nn is af fy lb yi".split(),
    "romance": "fr es pt it ro ca gl oc".split(),
    "slavic": "ru uk be pl cs sk bg sr hr bs sl mk".split(),
    "indo-aryan": "hi ur bn pa mr gu ne si".split(),
    "turkic": "tr az kk uz ky tk tt".split(),
    "uralic": "fi et hu".split(),
    "semitic": "ar he am mt".split(),
    "sinitic": "zh yue".split(),
}


def family_of(language: str) -> str:
    return next((f for f, known in FAMILIES.items() if language in known), language)


def _profile(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Square roots of the shares of hashed 1- to 3-grams of UTF-8 bytes, a row per text.

    Everything but letters (ASCII letters in lower case, bytes beyond ASCII) counts as one space.
    """
    low = _LETTER[data].astype(np.uint64)
    out = np.zeros((len(offsets) - 1, BINS), np.float32)
    grams = low
    for n in range(1, 4):
        if n > 1:
            grams = grams[:-1] * np.uint64(257) + low[n - 1 :]
        bins = (mix(grams + np.uint64(n << 40)) >> np.uint64(53)).astype(np.int64)
        for i in range(len(out)):
            a, b = offsets[i], offsets[i + 1] - n + 1
            if b > a:
                out[i] += np.bincount(bins[a:b], minlength=BINS) / (b - a)
    return np.sqrt(out)


_LETTER = np.full(256, 32, np.uint8)
_LETTER[0x61:0x7B] = np.arange(0x61, 0x7B)
_LETTER[0x41:0x5B] = np.arange(0x61, 0x7B)
_LETTER[0x80:] = np.arange(0x80, 0x100)


def _profiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part, data, offsets in slices(batches, "text"):
        x = _profile(data, offsets)
        flat = pa.ListArray.from_arrays(pa.array(np.arange(0, x.size + 1, BINS), pa.int32()), pa.array(x.ravel().astype(np.float64)))
        yield pa.RecordBatch.from_arrays([part.column(0), flat], ["lang", "x"])


@dataclass
class LanguageModel:
    """Linear machines (classes, then per pair of them a weight vector and an intercept).

    ``families`` decides between families; ``within`` has the machines of each family.  Bounded by
    the number of learned languages.
    """

    families: tuple
    within: dict[str, tuple]

    def predict(self, docs: DataFrame, text: str = "text") -> DataFrame:
        """All rows with ``lang_pred`` and ``score``; ``und`` and 0 if a text is null or has no letter.

        One-versus-one machines vote, each by the logistic of its margin; the class with the largest sum wins, ties
        go to the first in order.  The score is the family's mean vote times the language's.  Columns
        of these names give way.
        """
        shared = docs.sparkSession.sparkContext.broadcast((self.families, self.within))
        rows = pack(docs, text=F.col(text).cast("string"))
        out = rows.withColumn("_p", _predictor(shared)("text"))
        return unpack(out.select("_row", F.col("_p.lang_pred").alias("lang_pred"), F.col("_p.score").alias("score")), ["lang_pred", "score"])


def _vote(machines: tuple, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    classes, weights, intercepts = machines
    votes = np.zeros((len(x), len(classes)))
    if len(classes) == 1:
        return np.zeros(len(x), np.int64), np.ones(len(x))
    margins = x @ weights.T + intercepts
    for k, (i, j) in enumerate(combinations(range(len(classes)), 2)):
        share = 1 / (1 + np.exp(-np.clip(2 * margins[:, k], -30, 30)))
        votes[:, i] += share
        votes[:, j] += 1 - share
    best = votes.argmax(1)
    return best, votes[np.arange(len(x)), best] / (len(classes) - 1)


def _predictor(shared):
    def run(frames: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        families, within = shared.value
        for texts in frames:
            batch = pa.RecordBatch.from_arrays([pa.array(texts, pa.large_string())], ["text"])
            names, scores = [], []
            for part, data, offsets in slices(iter([batch]), "text"):
                x = _profile(data, offsets)
                named = np.full(len(x), UNKNOWN, object)
                score = np.zeros(len(x))
                lettered = np.array([t is not None and any(map(str.isalpha, t)) for t in part.column(0).to_pylist()], bool)
                if families[0]:
                    family, sure = _vote(families, x)
                    for f, name in enumerate(families[0]):
                        own = np.flatnonzero(lettered & (family == f))
                        if len(own):
                            best, more = _vote(within[name], x[own])
                            named[own] = np.array(within[name][0], object)[best]
                            score[own] = sure[own] * more
                names.append(named)
                scores.append(score)
            yield pd.DataFrame({"lang_pred": np.concatenate(names) if names else [], "score": np.concatenate(scores) if scores else []})

    return F.pandas_udf(run, "lang_pred string, score double")


def _machines(rows: DataFrame, classes: list[str], column: str) -> tuple:
    """One LinearSVC per pair of classes; rows have the class in ``column`` and features ``x``."""
    weights, intercepts = [], []
    for i, j in combinations(classes, 2):
        pair = rows.where(F.col(column).isin(i, j))
        pair = pair.select((F.col(column) == i).cast("double").alias("label"), "features")
        fitted = LinearSVC(maxIter=25, regParam=1e-4, standardization=False).fit(pair)
        weights.append(fitted.coefficients.toArray())
        intercepts.append(fitted.intercept)
    return classes, np.array(weights).reshape(len(weights), BINS), np.array(intercepts)


def fit_language(
    labelled: DataFrame, *, text: str = "text", lang: str = "lang", by: str | None = None, max_per_language: int = MAX_PER_LANGUAGE
) -> LanguageModel:
    """Fit on rows with a language and a letter: about ``max_per_language`` of each at most, whole texts.

    The sample is the share of rows whose hash of column ``by`` is lowest that gives that many of the language.
    Without ``by`` the text's hash is taken, which takes all rows of a text or none: name a row's id where texts
    repeat.  Repeated rows count as often as they come.  A language
    alone in its family needs no machine there; without rows the model knows nothing and answers ``und``.
    """
    chosen_by = F.xxhash64(F.col(by or text).cast("string"), F.lit(3)).alias("c")
    rows = labelled.select(F.col(lang).cast("string").alias("lang"), F.col(text).cast("string").alias("text"), chosen_by)
    rows = rows.where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not counts:
        return LanguageModel(([], np.zeros((0, BINS)), np.zeros(0)), {})
    place = F.pmod("c", F.lit(1 << 30)) / float(1 << 30)
    share = F.lit(1.0)
    for name, n in counts.items():
        if n > max_per_language:
            share = F.when(F.col("lang") == name, F.lit(max_per_language / n)).otherwise(share)
    chosen = rows.where(place < share).select("lang", "text").mapInArrow(_profiles, "lang string, x array<double>")
    chosen = stash(chosen, "language-profiles").coalesce(LEARN_TASKS)
    pairs = {n: family_of(n) for n in sorted(counts)}
    family = F.lit(None).cast("string")
    for name, f in pairs.items():
        family = F.when(F.col("lang") == name, F.lit(f)).otherwise(family)
    chosen = chosen.select("lang", family.alias("family"), array_to_vector("x").alias("features")).cache()
    families = sorted(set(pairs.values()))
    try:
        top = _machines(chosen, families, "family")
        within = {f: _machines(chosen, [n for n in pairs if pairs[n] == f], "lang") for f in families}
    finally:
        chosen.unpersist()
    return LanguageModel(top, within)
