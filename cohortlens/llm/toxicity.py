"""Toxicity: gradient-boosted trees over a dozen dense features per document
(lexicon densities, second-person proximity, capitals, punctuation and
obfuscation rates), calibrated by isotonic regression.

The lexicon and the trees are learned from a bounded sample of labelled rows
(``SAMPLE_ROWS``, chosen by a hash of the id, so every run takes the same
rows); where there are more, the rarer class fills up to half of it and rows
weigh what they stand for. A quarter is kept back for the calibration, of each
class if the hash alone leaves a part without one. Scoring covers every
document and reads its whole text; labels, language, source and id are never
inputs of a score.

Defined results: null and empty texts are scored from all-zero features;
repeated rows are scored alike, each on its own; several labels for one id
count as their largest, null labels and ids are not learned from; without
labels of both classes every score is the labelled mean (0 without labels);
where one class has a single row, which cannot be in both parts, scores are the
trees' own probability, uncalibrated; an empty table gives no rows. Only id and
text are read from the documents.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import checkpoint_dir
from .common import crc_bucket, fresh, text_batches

SAMPLE_ROWS = 10_000     # bound of the labelled rows that are learned from
LEXICON_SIZE = 200
MIN_SHARE, MIN_TEXTS = 0.02, 5   # of the toxic sample's texts hold a lexicon word
MIN_LIFT = 8.0           # how much more often toxic texts hold it
TREES, DEPTH, STEP, SEED = 25, 3, 0.2, 17
NEAR = 5                 # words between a second-person word and a lexicon word

# Second-person words of the four languages of the documents.
SECOND_PERSON = frozenset(
    "you your yours yourself tu te toi ton ta tes vous votre vos du dich dir dein deine ihr euch euer "
    "tú ti tus usted ustedes vosotros".split())
# Characters that stand in for letters.
LOOKALIKES = str.maketrans("013457@$!|", "oieastasil")

_TOKEN = re.compile(r"[^\x20\x09-\x0D]+")
_EDGE = "\"'.,;:!?()[]{}<>*_~`-…«»“”¿¡"
_INNER = re.compile(r"[\W_]+")
FEATURES = ("density", "hits", "distinct", "weight", "near_you", "you", "capitals", "exclaims",
            "punctuation", "obfuscated", "hidden_hits", "longest_run", "log_words")


def plain_token(raw: str) -> str:
    """Lower-cased, without punctuation at its ends."""
    return raw.lower().strip(_EDGE)


def revealed(token: str) -> str:
    """A token with look-alikes read as letters and inner marks removed."""
    return _INNER.sub("", token.translate(LOOKALIKES))


def features_of(text: str, lexicon: dict[str, float]) -> list[float]:
    raw = _TOKEN.findall(text)
    n = len(raw)
    if not n:
        return [0.0] * len(FEATURES)
    hits, you, hidden, obfuscated, weight = [], [], 0, 0, 0.0
    for i, w in enumerate(map(plain_token, raw)):
        if w in lexicon:
            hits.append(i)
            weight += lexicon[w]
        elif w in SECOND_PERSON:
            you.append(i)
        elif w and not w.isalpha():
            plain = revealed(w)
            if plain != w and any(c.isalpha() for c in w):
                obfuscated += 1
                if plain in lexicon:
                    hidden += 1
                    hits.append(i)
                    weight += lexicon[plain]
    near = sum(any(abs(i - j) <= NEAR for j in you) for i in hits) if hits and you else 0
    run = best = 0
    for a, b in zip(hits, hits[1:]):
        run = run + 1 if b - a <= NEAR else 0
        best = max(best, run)
    chars = len(text)
    capitals = sum(w.isupper() and len(w) > 1 for w in raw)
    return [100.0 * len(hits) / n, math.log1p(len(hits)), float(len({plain_token(raw[i]) for i in hits})),
            math.log1p(weight), math.log1p(near), 100.0 * len(you) / n, capitals / n,
            text.count("!") / n, sum(map(text.count, ".,;:?\"'()")) / chars, obfuscated / n,
            math.log1p(hidden), float(best), math.log1p(n)]


def feature_column(text: Column, lexicon: dict[str, float]) -> Column:
    @F.pandas_udf("array<double>")
    def udf(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([features_of(t or "", lexicon) for t in texts])
    return udf(text)


@dataclass
class ToxicityModel:
    """Lexicon, trees and calibration; ``base`` alone if nothing was learned."""
    lexicon: dict[str, float]
    trees: object = None
    calibration: object = None
    base: float = 0.0

    def score(self, df: DataFrame, text_col: str = "text", out: str = "score") -> DataFrame:
        """``df`` with a calibrated score in [0, 1]."""
        if self.trees is None:
            return df.withColumn(out, F.lit(self.base))
        row = df.select(F.struct("*").alias("__row"),
                        array_to_vector(feature_column(F.col(text_col), self.lexicon)).alias("__features"))
        raw = self.trees.transform(row).select("__row", vector_to_array("probability")[1].alias("__raw"))
        if self.calibration is None:
            return raw.select("__row.*", F.col("__raw").alias(out))
        done = self.calibration.transform(raw)
        value = F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.col("__calibrated")))
        return done.select("__row.*", value.alias(out))


def labelled_sample(docs: DataFrame, labels: DataFrame, learn_from, bound: int = SAMPLE_ROWS) -> DataFrame:
    """(doc_id, text, label, weight) of about ``bound`` labelled ids, the rarer
    class first, up to half of them, with one text per id (the one of least
    hash); the weight is the number of ids of its class that one stands for.
    Ids are drawn by their whole 64-bit hash, so any share can be drawn; a
    class that has labels but of which none is drawn is an error.
    ``learn_from`` is a condition on the id column."""
    label = F.col("toxic").cast("int")
    ids = (labels.select(F.col("doc_id"), label.alias("label"))
           .where(F.col("doc_id").isNotNull() & F.col("label").isNotNull() & learn_from(F.col("doc_id")))
           .groupBy("doc_id").agg(F.max("label").alias("label")))
    sizes = {r.label: r["count"] for r in ids.groupBy("label").count().collect()}     # a row per class
    rare = min(sizes, key=lambda c: (sizes[c], c), default=None)
    first = min(sizes.get(rare, 0), bound // 2)
    most = {c: hash_limit(first if c == rare else bound - first, n) for c, n in sizes.items()}
    drawn_if = F.lit(False)
    for c, limit in most.items():
        drawn_if = drawn_if | ((F.col("label") == c) & (F.xxhash64("doc_id") <= F.lit(limit)))
    picked = ids.where(drawn_if)
    drawn = {r.label: r["count"] for r in picked.groupBy("label").count().collect()}
    weight = F.lit(1.0)
    for c, n in sizes.items():
        if not drawn.get(c):
            raise ValueError(f"none of {n} labelled ids of class {c} was drawn; raise the bound of {bound}")
        weight = F.when(F.col("label") == c, F.lit(n / drawn[c])).otherwise(weight)
    # bounded by the sample size, so it may be broadcast
    found = (docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
             .join(F.broadcast(picked), "doc_id"))
    return (found.groupBy("doc_id", "label").agg(F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text"))
            .select("doc_id", "text", "label", weight.alias("weight")))


def hash_limit(wanted: int, rows: int) -> int:
    """Largest 64-bit hash to draw, for about ``wanted`` of ``rows`` ids."""
    return -2 ** 63 + min(2 ** 64, 2 ** 64 * wanted // max(rows, 1)) - 1 if wanted else -2 ** 63


def learn_lexicon(sample: DataFrame, size: int = LEXICON_SIZE) -> dict[str, float]:
    """Words that toxic texts hold far more often than clean ones, with their
    log lift; copies of a text count once."""
    @F.pandas_udf("array<string>")
    def tokens(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: list(
            {p for p in map(plain_token, _TOKEN.findall(t)) if p.isalpha()}))

    texts = sample.groupBy("text").agg(F.max("label").alias("label"))
    totals = {r.label: r.n for r in texts.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    bad, good = totals.get(1, 0), totals.get(0, 0)
    if not bad or not good:
        return {}
    counts = (texts.select("label", F.explode(tokens("text")).alias("word"))
              .groupBy("word").agg(F.sum("label").alias("a"), F.sum(1 - F.col("label")).alias("b")))
    lift = ((F.col("a") + 0.5) / (bad + 1)) / ((F.col("b") + 0.5) / (good + 1))
    rows = (counts.where(F.col("a") >= max(MIN_TEXTS, MIN_SHARE * bad))
            .select("word", F.log(lift).alias("w"), "a").where(lift >= MIN_LIFT)
            .orderBy((F.col("w") * F.col("a")).desc(), "word").limit(size).collect())
    return {r.word: float(r.w) for r in rows}


def fit(docs: DataFrame, labels: DataFrame, learn_from, bound: int = SAMPLE_ROWS) -> ToxicityModel:
    """Learn from labelled rows that satisfy ``learn_from``. Runs jobs; the
    sample and its features are checkpointed."""
    checkpoint_dir(docs.sparkSession)
    text_batches(docs.sparkSession)
    sample = labelled_sample(docs, labels, learn_from, bound).repartition(6, "doc_id").checkpoint()
    base = sample.agg((F.sum(F.col("label") * F.col("weight")) / F.sum("weight")).alias("m")).first()
    lexicon = learn_lexicon(sample)
    model = ToxicityModel(lexicon, base=float(base.m or 0.0))
    by_hash = (crc_bucket(F.col("doc_id"), 40) % 8).isin(1, 4)
    parts = sample.groupBy("label").agg(F.max(by_hash).alias("held"), F.max(~by_hash).alias("train")).collect()
    if len(parts) < 2:
        return model
    if all(r.held and r.train for r in parts):
        split = sample.withColumn("calibrates", by_hash)
    else:       # the sample is bounded, and so is a class of it
        turn = F.dense_rank().over(Window.partitionBy("label").orderBy(F.xxhash64("doc_id"), "doc_id"))
        split = sample.withColumn("calibrates", turn % 4 == 2)
    table = (split.select("label", "weight", "calibrates", feature_column(F.col("text"), lexicon).alias("f"))
             .select("label", "weight", "calibrates", array_to_vector("f").alias("__features"))
             .coalesce(2).checkpoint())
    train, held = table.where(~F.col("calibrates")), table.where("calibrates")
    model.trees = GBTClassifier(
        featuresCol="__features", labelCol="label", predictionCol="__prediction", weightCol="weight",
        maxIter=TREES, maxDepth=DEPTH, stepSize=STEP, seed=SEED).fit(train)
    if held.select("label").distinct().count() < 2:
        return model
    raw = model.trees.transform(held).select("label", "weight", vector_to_array("probability")[1].alias("__raw"))
    model.calibration = IsotonicRegression(
        featuresCol="__raw", labelCol="label", weightCol="weight",
        predictionCol="__calibrated").fit(raw.coalesce(1))
    return model


def toxicity_scores(docs: DataFrame, labels: DataFrame, folds: int = 5) -> DataFrame:
    """Score of every document by a model that has not seen fold 0."""
    fold = lambda c: crc_bucket(c, folds)
    model = fit(docs, labels, lambda c: fold(c) != 0)
    return (model.score(docs.select("doc_id", "text"))
            .select("doc_id", (fold(F.col("doc_id")) == 0).alias("held_out"), "score",
                    (F.col("score") >= 0.5).cast("int").alias("predicted")))


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """The documents scored below the threshold, with their own columns."""
    model = fit(docs, labels, lambda c: crc_bucket(c, 5) != 0)
    score = fresh(docs, "__score")
    return model.score(docs, out=score).where(F.col(score) < threshold).drop(score)
