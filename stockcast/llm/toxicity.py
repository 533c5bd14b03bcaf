"""Toxicity by gradient-boosted trees over dense text features, with isotonic calibration.

Features: densities of a learned lexicon, its closeness to second-person words, capitals, marks and
obfuscated spellings. The lexicon holds words and word beginnings that set labelled toxic texts apart;
it is learned from the training rows alone. Trees are grown by MLlib, calibrated on training rows that
the trees have not seen. Scoring is one pass over the texts: features come from an Arrow function that
remembers how it judged a word, trees and calibration run in the JVM.
"""

from __future__ import annotations

import math
import re
import uuid
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import Column, DataFrame, functions as F

from stockcast.llm.worker import keep
from stockcast.session import write_stage

MAX_TRAIN_ROWS = 20_000  # labelled rows that lexicon, trees and calibration are fitted on, by hash order
SEED = 42
FOLDS = 5                # crc32(doc_id) modulo this; 0 is held out
CALIBRATION_FOLD = 4     # training rows of this fold calibrate, the others grow trees
TREES, DEPTH, RATE = 30, 3, 0.25
LEXICON_SIZE = 400
MIN_DOCS = 8             # toxic texts that a lexicon entry must occur in
MIN_ODDS = 2.5           # log odds that a lexicon entry must reach
BEGINNINGS = (4, 5, 6)   # lengths of word beginnings that may enter the lexicon
NEAR = 5                 # words between a lexicon word and a second-person word
CACHE_SIZE = 100_000
TEXTS_AT_ONCE = 500      # texts whose terms are counted together before they are shuffled
#: Second-person words of English, German, French and Spanish: fixed values.
SECOND_PERSON = frozenset((
    "you your yours yourself u ur du dich dir dein deine deiner deinen ihr euch euer eure "
    "tu te toi ton ta tes vous votre vos tú ti tuyo usted ustedes vosotros os").split())
#: Characters that stand for letters in obfuscated words: fixed values.
LOOKALIKES = str.maketrans("01345780@$!", "oieastbo" + "asi")
EDGE = ".,;:!?\"'()[]{}…-«»¿¡*#$%&|<>"
INNER = re.compile(r"[^\W\d_][^\w\s'’-]+[^\W\d_]|[^\W\d_]\d+[^\W\d_]|([^\W\d_])\1{3,}")
NOT_LETTER, LONG_RUN = re.compile(r"[\W\d_]+"), re.compile(r"(.)\1{2,}")

FEATURES = (
    "hit_rate", "log_hits", "weight_rate", "top_weight", "near_rate", "second_rate", "hidden_rate", "log_hidden",
    "obfuscation_rate", "capital_rate", "shout_rate", "mark_rate", "exclaim_rate", "symbol_rate", "digit_rate", "log_words")
SECOND, OBFUSCATED, SHOUTED, HIDDEN = 1 << 10, 1 << 11, 1 << 12, 1 << 13  # over a ten-bit lexicon weight


def plain(word: str) -> str:
    return word.strip(EDGE).lower()


def unmasked(word: str) -> str:
    """A word with look-alike characters read as letters, other signs dropped and long runs shortened."""
    return LONG_RUN.sub(r"\1", NOT_LETTER.sub("", word.lower().translate(LOOKALIKES)))


def terms(word: str) -> list[str]:
    """Lexicon entries that a plain word could match: itself and its beginnings (marked with *)."""
    return [word, *[word[:n] + "*" for n in BEGINNINGS if len(word) > n]] if word else []


class WordCodes(dict):
    """What each word says, as one number; remembers words up to a bound."""

    def __init__(self, lexicon: dict[str, float]):
        super().__init__()
        self.lexicon = lexicon

    def weight(self, word: str) -> float:
        return max((self.lexicon.get(t, 0.0) for t in terms(word)), default=0.0)

    def __missing__(self, word: str) -> int:
        bare = plain(word)
        weight, code = self.weight(bare), 0
        if INNER.search(word.strip(EDGE)):
            code |= OBFUSCATED
        if not weight and (clear := unmasked(word)) != bare and (weight := self.weight(clear)):
            code |= HIDDEN
        if bare in SECOND_PERSON:
            code |= SECOND
        if len(bare) > 1 and word.isupper():
            code |= SHOUTED
        code |= min(1023, round(weight * 100))
        if len(self) >= CACHE_SIZE:
            self.clear()
        if len(word) <= 64:
            self[word] = code
        return code


def features(text: str, codes: WordCodes) -> list[float]:
    """The feature vector of one text; zeros without words."""
    words = text.split()
    if not words:
        return [0.0] * len(FEATURES)
    n = len(words)
    marks = np.fromiter(map(codes.__getitem__, words), dtype=np.int32, count=n)
    weight = (marks & 1023) / 100
    hits = np.flatnonzero(weight)
    second = np.flatnonzero(marks & SECOND)
    near = 0
    if len(hits) and len(second):
        right = np.searchsorted(second, hits)
        gap = np.minimum(
            np.abs(second[np.minimum(right, len(second) - 1)] - hits), np.abs(hits - second[np.maximum(right - 1, 0)]))
        near = int((gap <= NEAR).sum())
    hidden = int(np.count_nonzero(marks & HIDDEN))
    count = np.bincount(np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8), minlength=256)
    chars = float(count.sum())
    symbols = count[[35, 36, 37, 38, 42, 60, 62, 64, 94, 95, 124, 126]].sum()
    marked = count[33:48].sum() + count[58:65].sum() + count[91:97].sum() + count[123:127].sum()
    return [
        len(hits) / n, math.log1p(len(hits)), float(weight.sum()) / n, float(weight.max()), near / n, len(second) / n,
        hidden / n, math.log1p(hidden), np.count_nonzero(marks & OBFUSCATED) / n, count[65:91].sum() / chars,
        np.count_nonzero(marks & SHOUTED) / n, marked / chars, (count[33] + count[63]) / chars, symbols / chars,
        count[48:58].sum() / chars, math.log(n)]


def fold_of(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo the number of folds; null ids count as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % FOLDS


def training_rows(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_TRAIN_ROWS, seed: int = SEED) -> DataFrame:
    """doc_id, text, toxic and fold of at most ``max_rows`` labelled rows outside the held-out fold (written).

    Labels are chosen by a seeded hash of the id; several labels of one id count as toxic if one is.
    The chosen ids are broadcast, which ``max_rows`` bounds, so no text is shuffled.
    """
    chosen = (
        labels.select(F.col("doc_id").cast("long").alias("id"), F.col("toxic").cast("int").alias("toxic"))
        .where(F.col("id").isNotNull() & F.col("toxic").isNotNull() & (fold_of(F.col("id")) != 0))
        .groupBy("id").agg(F.max("toxic").alias("toxic"))
        .orderBy(F.xxhash64(F.lit(seed), "id"), "id").limit(max_rows))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return write_stage(
        texts.join(F.broadcast(chosen), texts["doc_id"] == chosen["id"]).select(
            "doc_id", "text", "toxic", fold_of(F.col("doc_id")).alias("fold")), "toxic-train")


def learn_lexicon(rows: DataFrame, size: int = LEXICON_SIZE, min_docs: int = MIN_DOCS) -> dict[str, float]:
    """Weights (smoothed log odds) of the words and beginnings that mark toxic texts best."""
    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (whole.slice(at, TEXTS_AT_ONCE) for whole in batches for at in range(0, whole.num_rows, TEXTS_AT_ONCE)):
            seen: tuple[Counter, Counter] = (Counter(), Counter())
            for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist()):
                seen[toxic > 0].update({t for w in set(text.split()) for t in terms(plain(w))})
            words = list(seen[0] | seen[1])
            yield pa.RecordBatch.from_arrays(
                [pa.array(words, pa.string()), *[pa.array([c[w] for w in words], pa.int64()) for c in seen]],
                ["term", "clean", "toxic"])

    totals = {r["toxic"] > 0: r["n"] for r in rows.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    odds = F.log((F.col("toxic") + 0.5) / (totals.get(True, 0) + 1)) - F.log((F.col("clean") + 0.5) / (totals.get(False, 0) + 1))
    scored = (
        rows.select("text", "toxic").mapInArrow(counted, "term string, clean long, toxic long")
        .groupBy("term").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
        .where(F.col("toxic") >= min_docs).withColumn("odds", odds).where(F.col("odds") >= MIN_ODDS))
    best = scored.orderBy(F.desc(F.col("odds") * F.log("toxic")), "term").limit(size)
    return {r["term"]: r["odds"] for r in best.collect()}


@dataclass
class ToxicityModel:
    """A fitted scorer. Without trees (no label, or one kind only) every score is ``prior``."""

    lexicon: dict[str, float]
    prior: float
    trees: GBTClassificationModel | None = None
    calibration: IsotonicRegressionModel | None = None

    def _vector(self, text: Column) -> Column:
        lexicon, ticket = self.lexicon, uuid.uuid4().hex

        @F.arrow_udf("array<double>")
        def vectors(texts: pa.Array) -> pa.Array:
            codes = keep(("words", ticket), lambda: WordCodes(lexicon))
            return pa.array([features(t.as_py() or "", codes) for t in texts], pa.list_(pa.float64()))

        return array_to_vector(vectors(text))

    def raw(self, docs: DataFrame, text: str) -> DataFrame:
        """Adds ``__p``: the trees' own probability."""
        with_vector = docs.withColumn("__x", self._vector(F.col(text)))
        return self.trees.transform(with_vector).withColumn("__p", vector_to_array("__probability")[1]).drop(
            "__x", "__raw", "__probability", "__class")

    def score(self, docs: DataFrame, text: str = "text", out: str = "score") -> DataFrame:
        """Adds the calibrated score in [0, 1]. Null texts count as empty; calibration keeps the trees' order."""
        if self.trees is None:
            return docs.withColumn(out, F.lit(self.prior))
        scored = self.raw(docs, text)
        if self.calibration is None:
            return scored.withColumn(out, F.col("__p")).drop("__p")
        scored = self.calibration.transform(scored)
        blended = 0.999 * F.col("__iso") + 0.001 * F.col("__p")  # tells rows of one calibration step apart
        return scored.withColumn(out, F.least(F.lit(1.0), F.greatest(F.lit(0.0), blended))).drop("__p", "__iso")


def fit(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_TRAIN_ROWS, seed: int = SEED) -> ToxicityModel:
    """Fit on labelled rows outside the held-out fold; ids, sources, languages and labels are never features.

    Null labels and labels without a document are left out. With no toxic or no clean training row the
    model is the share of toxic ones (0 without any row).
    """
    rows = training_rows(docs, labels, max_rows, seed)
    grown, held = F.col("fold") != CALIBRATION_FOLD, F.col("fold") == CALIBRATION_FOLD
    tally = rows.agg(*[F.count_if(part & (F.col("toxic") > 0) if toxic else part & (F.col("toxic") <= 0))
                       for part in (grown, held) for toxic in (True, False)]).first()
    toxic, clean, held_toxic, held_clean = tally
    if not toxic or not clean:
        return ToxicityModel({}, (toxic + held_toxic) / max(1, sum(tally)))
    model = ToxicityModel(learn_lexicon(rows.where(grown)), toxic / (toxic + clean))
    table = write_stage(
        rows.select((F.col("toxic") > 0).cast("double").alias("label"), "fold", model._vector(F.col("text")).alias("__x")), "toxic-table")
    trees = GBTClassifier(
        featuresCol="__x", labelCol="label", predictionCol="__class", maxIter=TREES, maxDepth=DEPTH, stepSize=RATE,
        maxBins=64, minInstancesPerNode=5, seed=seed,
    ).setProbabilityCol("__probability").setRawPredictionCol("__raw")
    model.trees = trees.fit(table.where(grown).repartition(6, "label", F.hash("__x")))
    if held_toxic and held_clean:
        probability = model.trees.transform(table.where(held)).select("label", vector_to_array("__probability")[1].alias("__p"))
        model.calibration = IsotonicRegression(featuresCol="__p", labelCol="label", predictionCol="__iso").fit(
            write_stage(probability, "toxic-calibration"))
    return model


def score_documents(docs: DataFrame, labels: DataFrame, **options: int) -> DataFrame:
    """doc_id, held_out, score and predicted of every row of ``docs``."""
    model = fit(docs, labels, **options)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return model.score(rows).select(
        "doc_id", (fold_of(F.col("doc_id")) == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def keep_clean(docs: DataFrame, labels: DataFrame, **options: int) -> DataFrame:
    """The rows of ``docs`` that are not predicted to be toxic, with their columns."""
    names = [f"__d{i}" for i in range(len(docs.columns))]
    text = names[docs.columns.index("text")]
    scored = fit(docs, labels, **options).score(docs.toDF(*names), text, "__score")
    return scored.where(F.col("__score") < 0.5).select(*[F.col(n).alias(c) for n, c in zip(names, docs.columns)])
