"""Toxicity: gradient-boosted trees over dense features, calibrated by isotonic regression."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import stash
from .rows import pack, unpack
from .text import release

MAX_ROWS = 60_000  # labelled rows that the model is fitted on
MAX_TERMS = 4_000  # learned words and word beginnings
LEARN_TASKS = 4
REJECT = 0.3

# General lexicons and second-person pronouns.
INSULTS = """idiot idiots moron morons stupid dumb fool fools clown clowns loser losers scum trash garbage
pathetic worthless disgusting ugly coward liar pig pigs dumbass imbecile jerk creep freak filth filthy vermin
idiota idiotas estúpido estúpida imbécil tonto basura asqueroso cerdo idiote stupide crétin débile ordure nul
dégoûtant salaud connard idiot dumm dummkopf trottel blöd blödmann abschaum dreck ekelhaft arschloch""".split()
PROFANITY = """damn hell crap shit fuck fucking fucked bitch bastard asshole ass puta mierda joder coño cabrón
merde putain salope scheiße scheisse verdammt mist""".split()
THREATS = "kill die dead hurt beat destroy burn shoot hang murder hate mata matar morir muere tuer crever töten stirb hass hasse".split()
SECOND_PERSON = """you your yours yourself u ur tú tu usted ustedes vosotros vous toi ton ta tes votre vos du dich dir
dein deine euch ihr sie""".split()

_WORD = re.compile(r"[^\W_]+")
_OBFUSCATED = re.compile(r"[^\W\d_][@$*#!0134]+[^\W\d_]|(?<!\w)(?:[^\W\d_][.\-_* ]){3,}[^\W\d_](?!\w)")
_REPEATED = re.compile(r"([^\W\d_])\1{2,}")
_PLAIN = str.maketrans("@$0134!", "asoieai")
NEAR = 5

FEATURES = [
    "insults", "profanity", "threats", "learned_words", "learned_starts", "learned_most", "insults_plain",
    "second_person", "near_second_person", "capitals", "shouted_words", "exclamations", "questions", "punctuation",
    "obfuscated", "repeated_letters", "log_words",
]


def _starts(word: str) -> list[str]:
    return [word[:n] + "~" for n in (4, 5, 6) if len(word) > n]


def features(text: str | None, words: dict[str, float], starts: dict[str, float], fours: set[str]) -> list[float]:
    """Dense features of a whole text: densities per word, rates per character.

    words and starts: learned terms; fours: the first four letters of the learned beginnings.
    """
    text = text or ""
    low = _WORD.findall(text.lower())
    n, size = max(1, len(low)), max(1, len(text))
    counted = Counter(low)
    sums = dict.fromkeys(("insults", "profanity", "threats", "second"), 0)
    learned = begun = most = 0.0
    hits = set()
    for w in counted.keys() & _LEXICON.keys():
        sums[_LEXICON[w]] += counted[w]
        if _LEXICON[w] == "insults":
            hits.add(w)
    for w in counted.keys() & words.keys():
        learned, most = learned + counted[w] * words[w], max(most, words[w])
        hits.add(w)
    for w in [w for w in counted if w[:4] in fours]:
        begin = max((starts.get(s, 0.0) for s in _starts(w)), default=0.0)
        if begin:
            begun, most = begun + counted[w] * begin, max(most, begin)
            hits.add(w)
    near = 0
    if hits and sums["second"]:
        you = [i for i, w in enumerate(low) if _LEXICON.get(w) == "second"]
        place = np.array(you)
        for i in (i for i, w in enumerate(low) if w in hits):
            at = np.searchsorted(place, i - NEAR)
            near += at < len(place) and place[at] <= i + NEAR
    odd = _OBFUSCATED.findall(text)
    plain = 0
    if odd:
        spelt = _WORD.findall(text.translate(_PLAIN).lower())
        plain = sum(_LEXICON.get(w) == "insults" for w in spelt) - sums["insults"]
    upper = len(_NOT_UPPER.sub("", text))
    shouted = sum(len(w) > 2 and w.isupper() for w in _WORD.findall(text)) if upper > n / 2 else 0
    marks = text.count("!"), text.count("?")
    other = sum(text.count(c) for c in ".,;:-\"'()*#@$%&")
    return [
        sums["insults"] / n, sums["profanity"] / n, sums["threats"] / n, learned / n, begun / n, most, plain / n,
        sums["second"] / n, near / n, upper / size, shouted / n, marks[0] / size, marks[1] / size, other / size,
        len(odd) / n, len(_REPEATED.findall(text)) / n, float(np.log1p(len(low))),
    ]


_LEXICON = dict.fromkeys(SECOND_PERSON, "second") | dict.fromkeys(THREATS, "threats") | dict.fromkeys(PROFANITY, "profanity") | dict.fromkeys(INSULTS, "insults")
_NOT_UPPER = re.compile(r"[^A-ZÀ-ÖØ-Þ]+")


def _featurize(terms):
    def run(frames: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        words = {t: s for t, s in terms.value.items() if not t.endswith("~")}
        starts = {t: s for t, s in terms.value.items() if t.endswith("~")}
        fours = {t[:4] for t in starts}
        for texts in frames:
            yield pd.DataFrame([features(t, words, starts, fours) for t in texts], columns=FEATURES)
            release()

    return F.pandas_udf(run, ", ".join(f"{f} double" for f in FEATURES))


def _terms_of(texts: pd.Series) -> pd.Series:
    """Distinct words and word beginnings of each text."""
    out = []
    for t in texts:
        low = {w.lower() for w in _WORD.findall(t or "")}
        out.append(sorted(low | {s for w in low for s in _starts(w)}))
    return pd.Series(out)


def learn_terms(rows: DataFrame) -> dict[str, float]:
    """Terms that toxic rows hold far more often than others, with their log odds.

    rows: text, label.  A term's evidence is its smoothed log odds, less two standard errors.
    """
    toxic = F.sum("label").alias("t")
    totals = rows.agg(F.coalesce(F.sum("label"), F.lit(0)), F.count("label")).first()
    bad, good = float(totals[0]), float(totals[1] - totals[0])
    terms_of = F.pandas_udf(_terms_of, "array<string>")
    seen = rows.select(F.explode(terms_of("text")).alias("term"), "label").groupBy("term").agg(toxic, F.count("label").alias("n"))
    clean = F.col("n") - F.col("t")
    odds = F.log((F.col("t") + 0.5) / (bad + 1)) - F.log((clean + 0.5) / (good + 1))
    error = F.sqrt(1 / (F.col("t") + 0.5) + 1 / (clean + 0.5))
    best = seen.where("t >= 5").select("term", (odds - 2 * error).alias("s")).where("s > 1")
    return {r["term"]: r["s"] for r in best.orderBy(F.desc("s"), "term").limit(MAX_TERMS).collect()}


@dataclass
class ToxicityModel:
    """Learned terms (at most ``MAX_TERMS``), trees and the calibration of their probability."""

    terms: dict[str, float]
    trees: PipelineModel | None
    calibration: IsotonicRegressionModel | None
    rate: float

    def score(self, docs: DataFrame, text: str = "text", threshold: float = REJECT) -> DataFrame:
        """All rows with ``score`` in 0 to 1 and ``predicted``; added columns take the place of others.

        Null texts are scored as empty ones, very long ones whole; equal texts get equal scores.
        """
        rows = pack(docs, _f=_features(docs, F.col(text), self.terms))
        if self.trees is None:
            rows = rows.withColumn("score", F.lit(self.rate))
        else:
            rows = self._calibrated(rows.select("_row", "_f.*"))
        rows = rows.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
        return unpack(rows, ["score", "predicted"])

    def _calibrated(self, rows: DataFrame) -> DataFrame:
        rows = _raw(self.trees, rows)
        out = self.calibration.transform(rows) if self.calibration else rows.withColumnRenamed("raw", "prediction")
        return out.withColumn("score", F.least(F.greatest("prediction", F.lit(0.0)), F.lit(1.0)))


def _features(docs: DataFrame, text: Column, terms: dict[str, float]) -> Column:
    return _featurize(docs.sparkSession.sparkContext.broadcast(terms))(text)


def _raw(trees: PipelineModel, rows: DataFrame) -> DataFrame:
    """Add the trees' probability as column ``raw``."""
    out = trees.transform(rows)
    return out.withColumn("raw", vector_to_array("probability")[1]).drop("features", "rawPrediction", "probability", "prediction")


def fit_toxicity(
    labelled: DataFrame, *, text: str = "text", label: str = "label", by: str | None = None, max_rows: int = MAX_ROWS, seed: int = 11
) -> ToxicityModel:
    """Fit on rows with label 0 or 1; about ``max_rows`` of them at most, chosen by the hash of column ``by``.

    Without ``by`` the text's hash chooses, which takes all rows of a text or none: name a row's id where
    texts repeat.  The rows are cut in three by the hash of the text, so that no part is judged by what it
    taught: a third gives the learned terms, a third the trees, a third the calibration.  Equal texts stay
    together.  Rows with another label are left out; null texts count as empty, very long ones are read whole;
    repeated rows count as often as they come.  If one part lacks one of the labels, the
    model answers with the share of toxic rows (0 without rows).
    """
    chosen = F.xxhash64(F.col(by or text).cast("string"), F.lit(seed))
    rows = labelled.select(F.coalesce(F.col(text), F.lit("")).alias("text"), F.col(label).cast("int").alias("label"), chosen.alias("c"))
    rows = rows.where("label in (0, 1)")
    total = rows.agg(F.count("label"), F.avg("label")).first()
    if total[0] > max_rows:
        share = max_rows / total[0]
        rows = rows.where(F.pmod(F.shiftright("c", 8), F.lit(1 << 20)) < int(share * (1 << 20)))
    part = F.pmod(F.xxhash64("text", F.lit(seed)), F.lit(3)).alias("part")
    rows = stash(rows.select("text", "label", part), "toxicity-labelled").coalesce(LEARN_TASKS)
    terms = learn_terms(rows.where("part = 0"))
    spread = rows.where("part > 0").select("label", "part", _features(rows, F.col("text"), terms).alias("f"))
    dense = stash(spread.select("label", "part", "f.*"), "toxicity-features").coalesce(LEARN_TASKS)
    some = dense.groupBy("part").agg(F.countDistinct("label").alias("k")).where("k = 2").count()
    if some < 2:
        return ToxicityModel({}, None, None, float(total[1] or 0.0))
    assembler = VectorAssembler(inputCols=FEATURES, outputCol="features")
    boosted = GBTClassifier(maxIter=15, maxDepth=4, stepSize=0.3, minInstancesPerNode=5, seed=seed, cacheNodeIds=False)
    fitted = boosted.fit(assembler.transform(dense.where("part = 1")))
    trees = PipelineModel([assembler, fitted])
    held = _raw(trees, dense.where("part = 2")).select("raw", F.col("label").cast("double").alias("label"))
    isotonic = IsotonicRegression(featuresCol="raw", labelCol="label").fit(stash(held, "toxicity-calibration").coalesce(1))
    return ToxicityModel(terms, trees, isotonic, float(total[1]))
