"""Document quality by a sparse ensemble of rules.

Statistics of a text (lengths, repetition, symbols, capitals, lines) feed a
random forest of shallow trees; every path from a root to a node is a rule, a
conjunction of comparisons. An L1-penalised logistic regression over the
rules and the scaled statistics keeps few of them, and the kept ones become one Spark column
expression: the score is plain SQL over the statistics.

Labels count only where ``crc32(doc_id) % 4 <> 2``; of contradicting labels
of one id the larger. At most ``SAMPLE`` labelled rows are used for fitting,
those with the smallest hash of the id; all documents are scored, whole. Null
and empty texts have all statistics 0 and get the score of such a text.
Without labels of both kinds every score is the share of good labels (0.5
without any). Rows without id are scored as held in.
"""

from __future__ import annotations

import math
import operator
import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, functions as F

from citelake.llm.common import column_batches
from citelake.llm.toxicity import labelled, remainder
from citelake.session import stage

#: Bound of the labelled rows used for fitting.
SAMPLE = 20_000
TREES, DEPTH = 12, 3
PENALTY = 0.002
SEED = 5
THRESHOLD = 0.7
BATCH = 512

STATISTICS = (
    "words", "word_length", "distinct", "top_word", "twice", "capitals", "symbols", "marked", "digits",
    "bars", "lines", "line_length", "same_lines", "long_words", "letters",
)

_CODES = np.zeros((4, 256), dtype=np.int64)
_CODES[0, [*range(65, 91)]] = 1  # capitals
_CODES[1, [*range(48, 58)]] = 1  # digits
_CODES[2, [c for c in range(33, 127) if not chr(c).isalnum()]] = 1  # symbols
_CODES[3, [*range(97, 123)] + [*range(128, 256)]] = 1  # small letters and all beyond ASCII
_MARKED = re.compile(r"[^\w\s]{2,}(?=\s|\Z)")


def text_statistics(text: str | None) -> tuple[float, ...]:
    """The values of ``STATISTICS``."""
    words = (text or "").split()
    if not words:
        return (0.0,) * len(STATISTICS)
    n = len(words)
    raw = np.bincount(np.frombuffer(text.encode(), dtype=np.uint8), minlength=256)
    capitals, digits, symbols, letters = (_CODES @ raw).tolist()
    size = sum(map(len, words))
    counts = Counter(words)
    lines = [line for line in text.split("\n") if line.strip()]
    return (
        math.log(n),
        size / n,
        len(counts) / n,
        max(counts.values()) / n,
        sum(map(operator.eq, words, words[1:])) / n,
        capitals / (capitals + letters + 1),
        symbols / size,
        len(_MARKED.findall(text)) / n,
        digits / size,
        text.count("|") / n,
        math.log1p(len(lines)),
        n / len(lines),
        1 - len(set(lines)) / len(lines),
        sum(len(w) > 30 for w in counts) / n,
        letters / size,
    )


def with_statistics(documents: DataFrame, keep: list[str]) -> DataFrame:
    """The columns ``keep`` of ``documents`` and ``STATISTICS``, prefixed with an underscore."""
    source = documents.select(*[F.col(f"`{c}`") for c in keep], F.col("text").cast("string").alias("_text"))
    types = ", ".join(f"_{name} double" for name in STATISTICS)
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema.fields[:-1])

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in column_batches(batches, BATCH):
            rows = [text_statistics(text) for text in batch.column(len(keep)).to_pylist()]
            values = [pa.array(list(c), type=pa.float64()) for c in zip(*rows)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], *values], names=[*batch.schema.names[:-1], *[f"_{x}" for x in STATISTICS]]
            )

    return source.mapInArrow(measure, f"{kept}, {types}")


class Rule(NamedTuple):
    """Comparisons (statistic, above, bound) that hold together."""

    terms: tuple[tuple[int, bool, float], ...]

    def column(self) -> Column:
        held = F.lit(True)
        for place, above, bound in self.terms:
            value = F.col(f"_{STATISTICS[place]}")
            held = held & ((value > bound) if above else (value <= bound))
        return held


def tree_rules(description: str) -> list[Rule]:
    """The paths of every tree in a forest's printed form, to inner nodes and leaves alike."""
    found: dict[Rule, None] = {}
    path: list[tuple[int, tuple[int, bool, float]]] = []
    pattern = re.compile(r"^( *)(?:If|Else) \(feature (\d+) (<=|>) (\S+)\)$")
    for line in description.split("\n"):
        got = pattern.match(line)
        if not got:
            continue
        depth = len(got[1])
        path = [p for p in path if p[0] < depth]
        path.append((depth, (int(got[2]), got[3] == ">", float(got[4]))))
        tightest: dict[tuple[int, bool], float] = {}
        for _, (place, above, bound) in path:
            old = tightest.get((place, above))
            tightest[place, above] = bound if old is None else (max if above else min)(old, bound)
        found[Rule(tuple(sorted((p, a, b) for (p, a), b in tightest.items())))] = None
    return list(found)


class Ensemble(NamedTuple):
    """Intercept, weighted rules and weighted statistics of the compiled score."""

    intercept: float
    rules: list[tuple[float, Rule]]
    linear: list[tuple[float, int]]

    def score(self) -> Column:
        margin = F.lit(self.intercept)
        for weight, rule in self.rules:
            margin = margin + F.when(rule.column(), weight).otherwise(0.0)
        for weight, place in self.linear:
            margin = margin + F.col(f"_{STATISTICS[place]}") * weight
        return 1 / (1 + F.exp(-margin))


def fit(documents: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Ensemble:
    """Fit on the labelled rows of ``documents`` that are not held out."""
    ids = stage(labelled(labels, "quality", remainder(F.col("doc_id"), 4) == 2, sample), "quality-labels")
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(ids), "doc_id")
    rows = stage(with_statistics(texts, ["doc_id", "label"]), "quality-sample")
    share, low, high = rows.agg(F.avg("label"), F.min("label"), F.max("label")).first()
    if share is None or low == high:
        share = min(max(0.5 if share is None else share, 1e-6), 1 - 1e-6)
        return Ensemble(math.log(share / (1 - share)), [], [])
    names = [f"_{name}" for name in STATISTICS]
    vectors = VectorAssembler(inputCols=names, outputCol="_vector").transform(rows.coalesce(1))
    forest = RandomForestClassifier(
        featuresCol="_vector", labelCol="label", numTrees=TREES, maxDepth=DEPTH, seed=SEED, minInstancesPerNode=3,
        featureSubsetStrategy="onethird",
    ).fit(vectors)
    rules = tree_rules(forest.toDebugString)
    flags = rows.select("label", *names, *[r.column().cast("double").alias(f"_r{i}") for i, r in enumerate(rules)])
    columns = [f"_r{i}" for i in range(len(rules))] + names
    lasso = LogisticRegression(
        featuresCol="_vector", labelCol="label", elasticNetParam=1.0, regParam=PENALTY, maxIter=60,
    ).fit(VectorAssembler(inputCols=columns, outputCol="_vector").transform(flags.coalesce(1)))
    weights = lasso.coefficients.toArray().tolist()
    return Ensemble(
        float(lasso.intercept),
        [(w, r) for w, r in zip(weights, rules) if w],
        [(w, i) for i, w in enumerate(weights[len(rules) :]) if w],
    )


def score_quality(documents: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row of ``documents``."""
    score = fit(documents, labels, sample).score()
    return with_statistics(documents, ["doc_id"]).select(
        "doc_id",
        (remainder(F.col("doc_id"), 4) == 2).alias("held_out"),
        score.alias("score"),
        (score >= THRESHOLD).cast("int").alias("predicted"),
    )
