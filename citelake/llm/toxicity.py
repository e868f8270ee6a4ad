"""Toxic documents by gradient-boosted trees over dense features.

The lexicon is learned: words, and beginnings of five letters, that occur in
toxic texts of one part of the labelled sample and hardly in others. The
features count how densely they stand in a text, how near to words of second
person, how often behind disguises (``st*pid``, ``1d10t``), besides capitals
and punctuation. The trees are fitted on another part of the sample, and an
isotonic curve on a third turns their margin into a probability. Scoring
uses the lexicon of the whole sample.

Labels count only where ``crc32(doc_id) % 5 <> 0``; of contradicting labels
of one id the larger. At most ``SAMPLE`` labelled rows are used, those with the
smallest hash of the id; all documents are scored, whole. Null and empty
texts have all features 0 and get the score of such a text. Without labels of
both kinds every score is the share of toxic labels (0 without any). Rows
without id are scored as held in.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from itertools import accumulate
from typing import NamedTuple

import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame, functions as F

from citelake.llm.common import column_batches, small_batches
from citelake.session import stage

#: Bound of the labelled rows used for fitting.
SAMPLE = 20_000
#: Terms of the lexicon at most, and documents a term must be in.
TERMS, TERM_DOCS = 2000, 3
STEM = 5
TREES, DEPTH = 20, 3
SEED = 11
THRESHOLD = 0.5
BATCH = 512

# Words of second person in the languages of the corpus.
SECOND_PERSON = frozenset(
    "you your yours yourself u ur tu te toi ton ta tes vous votre vos du dich dir dein deine ihr euch euer "
    "tú ti tuyo tuya usted ustedes vosotros os su sus".split()
)
# Signs that stand for letters in disguised words.
DISGUISES = str.maketrans("013457@$!|*", "oieastasii ")

FEATURES = (
    "hits", "density", "stem_hits", "stem_density", "near_you", "hidden", "hidden_density",
    "capitals", "exclaims", "punctuation", "odd_words", "length",
)

_WORD = re.compile(r"\w+")
_TOKEN = re.compile(r"\S+")
_ODD = re.compile(r"\w[0-9@$!|*]+\w")
_NEAR = 6


class Lexicon(NamedTuple):
    words: frozenset
    stems: frozenset


def remainder(doc_id: Column, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``; null ids count as 1."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % parts, F.lit(1))


def text_features(text: str | None, lexicon: Lexicon) -> tuple[float, ...]:
    """The values of ``FEATURES``."""
    text = text or ""
    lower = text.lower()
    words = _WORD.findall(lower)
    if not words:
        return (0.0,) * len(FEATURES)
    n = len(words)
    places = [i for i, w in enumerate(words) if w in lexicon.words]
    stems = sum(w[:STEM] in lexicon.stems for w in words)
    near = 0
    if places:
        before = [0, *accumulate(w in SECOND_PERSON for w in words)]
        near = sum(before[min(n, i + _NEAR + 1)] > before[max(0, i - _NEAR)] for i in places)
    hidden = odd = 0
    if _ODD.search(lower):
        for token in _TOKEN.findall(lower):
            if _ODD.search(token):
                odd += 1
                plain = token.strip("\"'.,;:!?()").translate(DISGUISES).replace(" ", "")
                hidden += plain in lexicon.words or plain[:STEM] in lexicon.stems
    marks = len(text) - sum(map(len, words)) - text.count(" ") - text.count("\n")
    return (
        float(len(places)), len(places) / n, float(stems), stems / n, float(near), float(hidden), hidden / n,
        sum(map(str.isupper, _WORD.findall(text))) / n, text.count("!") / n, marks / n, odd / n, math.log(n),
    )


def with_features(documents: DataFrame, lexicon: Lexicon, keep: list[str]) -> DataFrame:
    """The columns ``keep`` of ``documents`` and ``FEATURES``, prefixed with an underscore."""
    small_batches(documents.sparkSession)
    held = documents.sparkSession.sparkContext.broadcast(lexicon)
    source = documents.select(*[F.col(f"`{c}`") for c in keep], F.col("text").cast("string").alias("_text"))
    types = ", ".join(f"_{name} double" for name in FEATURES)
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema.fields[:-1])

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in column_batches(batches, BATCH):
            rows = [text_features(text, held.value) for text in batch.column(len(keep)).to_pylist()]
            values = [pa.array(list(c), type=pa.float64()) for c in zip(*rows)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], *values], names=[*batch.schema.names[:-1], *[f"_{x}" for x in FEATURES]]
            )

    return source.mapInArrow(measure, f"{kept}, {types}")


def labelled(labels: DataFrame, column: str, held_out: Column, sample: int) -> DataFrame:
    """``doc_id, label`` (0.0 or 1.0) of at most ``sample`` ids that are not held out."""
    return (
        labels.where(F.col("doc_id").isNotNull() & F.col(column).isNotNull() & ~held_out)
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.max(F.col(column)).cast("double").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(sample)
    )


def learned_lexicon(rows: DataFrame) -> Lexicon:
    """Terms of toxic texts that others hardly have, out of ``text, label``: one row per text and term is counted."""
    words = F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(r"[\p{L}\p{N}_]+"), F.lit(0)))
    stems = F.array_distinct(
        F.transform(F.filter("words", lambda w: F.length(w) >= STEM), lambda w: F.substring(w, 1, STEM))
    )
    counted = (
        rows.dropDuplicates(["text"])
        .select("label", words.alias("words"))
        .select(
            "label",
            F.explode(
                F.concat(
                    F.transform("words", lambda w: F.struct(F.lit(False).alias("stem"), w.alias("term"))),
                    F.transform(stems, lambda w: F.struct(F.lit(True).alias("stem"), w.alias("term"))),
                )
            ).alias("at"),
        )
        .groupBy("at")
        .agg(F.sum("label").alias("yes"), F.count("*").alias("all"))
        .where((F.col("yes") >= TERM_DOCS) & (F.col("all") <= F.col("yes") * 1.1))
        .orderBy(F.desc("yes"), "at")
        .limit(TERMS)
        .collect()
    )
    return Lexicon(
        frozenset(r["at"]["term"] for r in counted if not r["at"]["stem"]),
        frozenset(r["at"]["term"] for r in counted if r["at"]["stem"]),
    )


class Model:
    """A fitted scorer; ``constant`` stands for it where there was nothing to fit."""

    def __init__(self, constant: float, lexicon=None, trees=None, curve=None):
        self.constant, self.lexicon, self.trees, self.curve = constant, lexicon, trees, curve

    def score(self, documents: DataFrame, keep: list[str]) -> DataFrame:
        """The columns ``keep`` and ``_score`` of every row."""
        if self.trees is None:
            return documents.select(*[F.col(f"`{c}`") for c in keep], F.lit(self.constant).alias("_score"))
        rows = self.curve.transform(_margin(self.trees, with_features(documents, self.lexicon, keep)))
        score = F.least(F.greatest(F.col("_curve"), F.lit(0.0)), F.lit(1.0))
        return rows.select(*[F.col(f"`{c}`") for c in keep], score.alias("_score"))


def _assembled(rows: DataFrame) -> DataFrame:
    return VectorAssembler(inputCols=[f"_{x}" for x in FEATURES], outputCol="_vector").transform(rows)


def _margin(trees, rows: DataFrame) -> DataFrame:
    from pyspark.ml.functions import vector_to_array

    scored = trees.transform(_assembled(rows))
    return scored.withColumn("_margin", vector_to_array("_raw")[1])


def fit(documents: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """Fit on the labelled rows of ``documents`` that are not held out."""
    ids = stage(labelled(labels, "toxic", remainder(F.col("doc_id"), 5) == 0, sample), "toxic-labels")
    share, low, high = ids.agg(F.avg("label"), F.min("label"), F.max("label")).first()
    if share is None or low == high:
        return Model(float(share or 0.0))
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(ids), "doc_id")
    fold = F.pmod(F.xxhash64(F.lit(SEED), "doc_id"), F.lit(10))
    texts = stage(texts.select("doc_id", "text", "label", fold.alias("fold")), "toxic-sample")
    lexicon = learned_lexicon(texts.where("fold < 5"))
    rows = stage(with_features(texts.where("fold >= 5"), lexicon, ["doc_id", "label", "fold"]), "toxic-features")
    fitting, rest = rows.where("fold < 8"), rows.where("fold >= 8")
    if fitting.select("label").distinct().count() < 2 or rest.isEmpty():
        return Model(float(share))
    trees = GBTClassifier(
        featuresCol="_vector", labelCol="label", predictionCol="_side",
        maxIter=TREES, maxDepth=DEPTH, stepSize=0.2, seed=SEED, minInstancesPerNode=2,
    )
    trees = trees.setRawPredictionCol("_raw").setProbabilityCol("_chance").fit(_assembled(fitting.coalesce(1)))
    curve = IsotonicRegression(featuresCol="_margin", labelCol="label", predictionCol="_curve").fit(
        _margin(trees, rest).select("_margin", "label")
    )
    # The features mean the same with a fuller lexicon, so scoring uses that of the whole sample.
    return Model(float(share), learned_lexicon(texts), trees, curve)


def score_toxicity(documents: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row of ``documents``."""
    scored = fit(documents, labels, sample).score(documents, ["doc_id"])
    return scored.select(
        "doc_id",
        (remainder(F.col("doc_id"), 5) == 0).alias("held_out"),
        F.col("_score").alias("score"),
        (F.col("_score") >= THRESHOLD).cast("int").alias("predicted"),
    )


def without_toxic(documents: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """The rows of ``documents`` that are not predicted toxic, with all their columns."""
    packed = documents.select(
        F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("_row"), F.col("text")
    )
    scored = fit(documents, labels, sample).score(packed, ["_row"])
    return scored.where(F.col("_score") < THRESHOLD).select("_row.*")
