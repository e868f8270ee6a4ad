"""Quality rules: divergence of a document's histograms from its language's reference.

Two histograms describe a text: bytes by character class (``CLASSES``) and terms (runs of ASCII letters, lower-cased,
and of characters beyond ASCII) by common word, all others in one bin. The reference of a language is worked out from
all its documents: a common word is one that makes up at least 1 in ``COMMON`` of the language's terms, and a bin's
reference share is the lower median of its shares over ``SHARDS`` shards of the documents. A document's shard follows
from its greatest term, so copies of one text, however many, sit in one shard and cannot move the median. A text
fails if its Jensen-Shannon divergence (base 2, the squared distance) from the reference exceeds a limit that widens
for short texts: ``WORD_LIMIT + WORD_SLACK / terms``, ``CLASS_LIMIT + CLASS_SLACK / bytes``. Length guards: texts of
fewer than ``LEAST_TERMS`` terms or ``LEAST_BYTES`` bytes are not held to the one or the other, and languages of fewer
than ``LEAST_REFERENCE`` terms have no reference, so nothing of theirs fails by it. Base rules come before: at least
``LEAST_WORDS`` words, and at most half of the words in three-word windows that occur twice or more.

Words are counted in bounded memory and exactly. A task forgets its counts at ``HELD`` words and passes on those that
made up 1 in ``2 * COMMON`` of the terms since; a word that is common overall must do so in some stretch, and the sum
of what was passed on leaves at most ``2 * COMMON`` candidates a language. A second pass counts these. The references
(one of at most ``COMMON`` words a language with ``LEAST_REFERENCE`` terms) go to the tasks with the job.

Null texts are empty: no words, base failed. A null language is one of its own. Very long texts are one row's work,
linear in their length. Repeated rows are judged alike; equal documents give equal results whatever their ids. An
empty table gives no rows. Other columns never matter.
"""

from __future__ import annotations

import hashlib
import math
from collections import Counter, defaultdict
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from citelake.llm.common import column_batches
from citelake.session import stage

COMMON = 2000
SHARDS = 16
LEAST_REFERENCE = 10_000
LEAST_TERMS, LEAST_BYTES = 50, 200
WORD_LIMIT, WORD_SLACK = 0.10, 30.0
CLASS_LIMIT, CLASS_SLACK = 0.05, 25.0
LEAST_WORDS = 50
HELD = 500_000
BATCH = 256
#: Shares are whole numbers of this many parts.
PARTS = 1_000_000_000

CLASSES = ("small", "capital", "digit", "blank", "stop", "sign", "beyond")
_SYMBOLS = b"#*$%&|<>"


def _class_of(byte: int) -> str:
    c = chr(byte)
    if byte > 127:
        return "beyond"
    if c.isalpha():
        return "small" if c.islower() else "capital"
    if c.isdigit():
        return "digit"
    if c in " \t\n\x0b\f\r":
        return "blank"
    return "stop" if c in ".,;:!?'\"()-" else "sign"


_CLASS = np.array([[_class_of(b) == c for c in CLASSES] for b in range(256)], dtype=np.int64)
#: Letters small, bytes beyond ASCII as they are, all else blank: terms are what ``split`` leaves.
_TO_TERMS = bytes(ord(chr(b).lower()) if b < 128 and chr(b).isalpha() else b if b > 127 else 32 for b in range(256))


def terms_of(text: bytes) -> list[bytes]:
    return text.translate(_TO_TERMS).split()


def byte_counts(text: bytes) -> np.ndarray:
    return np.bincount(np.frombuffer(text, dtype=np.uint8), minlength=256)


def shard_of(terms) -> str:
    """The first hexadecimal digit of the greatest term's MD5."""
    return hashlib.md5(max(terms)).hexdigest()[0]


class Base(NamedTuple):
    """What the base rules look at."""

    n_words: int
    word_chars: int
    n_symbols: int
    n_dup_lines: int
    n_repeat_words: int

    def failed(self) -> bool:
        return self.n_words < LEAST_WORDS or 100 * self.n_repeat_words > 50 * self.n_words


def repeated_words(words: list[bytes]) -> int:
    """How many words lie in three-word windows found at two places or more."""
    windows = list(zip(words, words[1:], words[2:]))
    counts = Counter(windows)
    if len(counts) == len(windows):
        return 0
    held = np.zeros(len(words), dtype=bool)
    at = np.flatnonzero([counts[w] > 1 for w in windows])
    for step in range(3):
        held[at + step] = True
    return int(held.sum())


def base_of(text: bytes, counts: np.ndarray) -> Base:
    words = text.split()
    blanks = int(counts[[32, *range(9, 14)]].sum())
    points = len(text) - int(counts[128:192].sum())  # continuation bytes start no character
    lines = [line for line in text.split(b"\n") if line.strip()]
    return Base(
        len(words), points - blanks, int(counts[list(_SYMBOLS)].sum()), len(lines) - len(set(lines)), repeated_words(words)
    )


# ------------------------------------------------------------------ reference

def _texts(documents: DataFrame, keep: list[str]) -> DataFrame:
    text = F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")
    lang = F.when(F.col("lang").isNull(), "-").otherwise(F.concat(F.lit("+"), F.col("lang").cast("string")))
    return documents.select(*[F.col(f"`{c}`") for c in keep], lang.alias("_lang"), text.alias("_text"))


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, bytes]]:
    for batch in column_batches(batches, BATCH):
        yield from zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())


def _frequent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``lang, word, n, terms``: the words frequent in a stretch of documents; the stretch's total without a word."""
    schema = pa.schema([("lang", pa.string()), ("word", pa.binary()), ("n", pa.int64()), ("terms", pa.int64())])
    counts: dict[str, Counter] = defaultdict(Counter)

    def emit(lang: str, held: Counter) -> pa.RecordBatch:
        total = held.total()
        often = [(w, n) for w, n in held.items() if n * 2 * COMMON >= total]
        rows = [{"lang": lang, "word": w, "n": n, "terms": total} for w, n in often]
        return pa.RecordBatch.from_pylist([*rows, {"lang": lang, "word": None, "n": 0, "terms": total}], schema)

    size = 0
    for lang, text in _rows(batches):
        held = counts[lang]
        size -= len(held)
        held.update(terms_of(text))
        size += len(held)
        if size > HELD:
            yield from (emit(*item) for item in counts.items())
            counts.clear()
            size = 0
    yield from (emit(*item) for item in counts.items())


def candidates(texts: DataFrame) -> dict[str, list[bytes]]:
    """At most ``2 * COMMON`` words a language, all its common words among them; languages without a reference left out."""
    found = stage(texts.select("_lang", "_text").mapInArrow(_frequent, "lang string, word binary, n long, terms long"), "frequent")
    totals = found.where("word IS NULL").groupBy("lang").agg(F.sum("terms").alias("total"))
    sums = found.where("word IS NOT NULL").groupBy("lang", "word").agg(F.sum("n").alias("n"), F.sum("terms").alias("seen"))
    # Elsewhere the word stayed below 1 in 2 * COMMON.
    may = F.col("n") * 2 * COMMON + (F.col("total") - F.col("seen")) >= F.col("total") * 2
    rows = sums.join(F.broadcast(totals.where(F.col("total") >= LEAST_REFERENCE)), "lang").where(may)
    words: dict[str, list[bytes]] = defaultdict(list)
    for row in rows.select("lang", "word").collect():
        words[row.lang].append(bytes(row.word))
    return dict(words)


def _counted(words: dict[str, list[bytes]]) -> Callable:
    """Sums of a task: ``lang, shard, word, n``. Classes come under negative places, the terms' total under a null word."""
    schema = pa.schema([("lang", pa.string()), ("shard", pa.string()), ("place", pa.int32()), ("n", pa.int64())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places = {lang: {w: i for i, w in enumerate(held)} for lang, held in words.items()}
        sums: dict[tuple[str, str], np.ndarray] = {}
        for lang, text in _rows(batches):
            known = places.get(lang)
            terms = Counter(terms_of(text)) if known else None
            if not terms:
                continue
            row = sums.setdefault((lang, shard_of(terms)), np.zeros(len(known) + len(CLASSES) + 1, dtype=np.int64))
            for word in terms.keys() & known.keys():
                row[known[word]] += terms[word]
            row[len(known) : -1] += byte_counts(text) @ _CLASS
            row[-1] += terms.total()
        for (lang, shard), row in sums.items():
            places_of = np.arange(len(row), dtype=np.int32)
            places_of[len(row) - len(CLASSES) - 1 :] = [-1 - i for i in range(len(CLASSES) + 1)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(row)), pa.array([shard] * len(row)), pa.array(places_of), pa.array(row)], schema=schema
            )

    return count


class Reference(NamedTuple):
    """Shares (of 1) of the classes, of each common word, and of all other terms."""

    classes: np.ndarray
    words: dict[bytes, float]
    other: float


def references(documents: DataFrame) -> dict[str, Reference]:
    """The reference of every language with enough terms, by its key (``+`` and the language; ``-`` for null)."""
    texts = _texts(documents, [])
    words = candidates(texts)
    counted = texts.mapInArrow(_counted(words), "lang string, shard string, place int, n long")
    sums = stage(counted.groupBy("lang", "shard", "place").agg(F.sum("n").alias("n")), "reference")
    whole = Window.partitionBy("lang", "shard")
    last = -1 - len(CLASSES)
    total = F.max(F.when(F.col("place") == last, F.col("n"))).over(whole)
    size = F.sum(F.when((F.col("place") < 0) & (F.col("place") > last), F.col("n"))).over(whole)
    share = F.expr(f"n * {PARTS} div if(place < 0, _size, _total)")
    held = F.sort_array(F.collect_list("share"))  # of at most SHARDS
    bins = (
        sums.withColumn("_total", total).withColumn("_size", size).withColumn("share", share)
        .groupBy("lang", "place")
        .agg(F.element_at(held, F.floor((F.size(held) + 1) / 2).cast("int")).alias("share"), F.sum("n").alias("n"))
    )
    by_lang: dict[str, dict[int, tuple[int, int]]] = defaultdict(dict)
    for row in bins.collect():  # at most 2 * COMMON + 8 a language with a reference
        by_lang[row.lang][row.place] = (row.share, row.n)
    found = {}
    for lang, held in by_lang.items():
        terms = held[last][1]
        classes = np.array([held[-1 - i][0] for i in range(len(CLASSES))], dtype=float)
        common = {w: held[i][0] for i, w in enumerate(words[lang]) if held[i][1] * COMMON >= terms}
        other = max(PARTS - sum(common.values()), 0)
        size = sum(common.values()) + other
        found[lang] = Reference(classes / classes.sum(), {w: s / size for w, s in common.items()}, other / size)
    return found


# -------------------------------------------------------------------- verdict

def _half(p: float, q: float) -> float:
    """The part of a bin in the divergence: shares ``p`` and ``q``."""
    m = (p + q) / 2
    return ((p * math.log2(p / m) if p else 0.0) + (q * math.log2(q / m) if q else 0.0)) / 2


def class_divergence(classes: np.ndarray, reference: Reference) -> float:
    size = float(classes.sum())
    return sum(_half(int(n) / size, float(q)) for n, q in zip(classes, reference.classes))


def word_divergence(terms: Counter, reference: Reference) -> float:
    size = terms.total()
    there = terms.keys() & reference.words.keys()
    known = sum(terms[w] for w in there)
    absent = 1.0 - reference.other - sum(reference.words[w] for w in there)
    found = sum(_half(terms[w] / size, reference.words[w]) for w in there)
    return found + _half((size - known) / size, reference.other) + max(absent, 0.0) / 2


class Verdict(NamedTuple):
    """Divergences where the length guards allow them, and whether one is beyond its limit."""

    word_js: float | None
    class_js: float | None
    diverged: bool


def judge(text: bytes, counts: np.ndarray, reference: Reference | None) -> Verdict:
    if reference is None:
        return Verdict(None, None, False)
    word_js = class_js = None
    terms = Counter(terms_of(text))
    n = terms.total()
    if n >= LEAST_TERMS:
        word_js = word_divergence(terms, reference)
    if len(text) >= LEAST_BYTES:
        class_js = class_divergence(counts @ _CLASS, reference)
    far = word_js is not None and word_js > WORD_LIMIT + WORD_SLACK / n
    odd = class_js is not None and class_js > CLASS_LIMIT + CLASS_SLACK / len(text)
    return Verdict(word_js, class_js, far or odd)


def quality_rules(documents: DataFrame) -> DataFrame:
    """``doc_id``, the five counts of ``Base``, ``base_failed``, ``kept``, and the divergences ``word_js, class_js``."""
    known = references(documents)
    source = _texts(documents, ["doc_id"])
    id_type = source.schema["doc_id"].dataType.simpleString()
    longs = ", ".join(f"{name} long" for name in Base._fields)
    types = f"doc_id {id_type}, {longs}, base_failed boolean, kept boolean, word_js double, class_js double"
    names = ["doc_id", *Base._fields, "base_failed", "kept", "word_js", "class_js"]

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in column_batches(batches, BATCH):
            rows = []
            for lang, text in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                counts = byte_counts(text)
                base = base_of(text, counts)
                verdict = judge(text, counts, known.get(lang))
                failed = base.failed()
                rows.append((*base, failed, not failed and not verdict.diverged, verdict.word_js, verdict.class_js))
            kinds = [pa.int64()] * len(Base._fields) + [pa.bool_()] * 2 + [pa.float64()] * 2
            columns = [pa.array(list(c), type=t) for c, t in zip(zip(*rows), kinds)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=names)

    return source.mapInArrow(apply, types)
