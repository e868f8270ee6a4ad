import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from citelake.llm import source_audit as A
from tests.llm.tables import DOCUMENTS, ODD_ROWS, documents, given, widened

TERM = re.compile(r"[^\x00-\x40\x5b-\x60\x7b-\x7f]+")


def terms_of(text):
    return [re.sub("[A-Z]", lambda m: m[0].lower(), t) for t in TERM.findall(text or "")]


def plain(docs, least=3, top=200):
    """All of it by the contract: docs are (lang, source, text)."""
    docs = [(lang or "", source or "", terms_of(text)) for lang, source, text in docs]
    out = set()
    for lang in {d[0] for d in docs}:
        own = [(s, t) for la, s, t in docs if la == lang]
        spread = Counter(w for _, t in own for w in set(t))
        kept = [w for w, n in spread.items() if n >= least]
        counts = defaultdict(Counter)
        for s, t in own:
            counts[s].update(w for w in t if spread[w] >= least)
        whole = sum(counts.values(), Counter())
        weight = lambda c, w: 1 + 10**9 * (c[w] + 1) // (c.total() + len(kept))
        value = lambda p, q: (p - q) ** 2 // q
        for s in counts:
            pairs = [(-sum(value(weight(counts[s], w), weight(counts[o], w)) for w in kept), o.encode(), o) for o in counts if o != s]
            terms = [
                (-value(weight(counts[s], w), weight(whole, w)), w.encode(), w) for w in kept
                if counts[s][w] and weight(counts[s], w) > weight(whole, w)
            ]
            for part, rows in (("pair", sorted(pairs)), ("term", sorted(terms)[:top])):
                out |= {(lang, s, part, item, -v, i + 1) for i, (v, _, item) in enumerate(rows)}
    return out


def got(df, **how):
    rows = A.source_audit(df, **how).collect()
    assert len(set(rows)) == len(rows)
    return {tuple(r) for r in rows}


def made(seed, n, sources):
    rng = random.Random(seed)
    words = [a + b for a in "abcdefghijklmnop" for b in "aeiouäß"] + ["Ünd", "THE", "the", "x1y", "漢字"]
    weights = [1 / (i + 1) for i in range(len(words))]
    return [
        (rng.choice(["en", "en", "de", None]), rng.choice(sources),
         " ".join(rng.choices(words, weights, k=rng.randint(0, 40))) + rng.choice(["", ".", "\n| 12"]))
        for _ in range(n)
    ]


def frame(spark, rows):
    return spark.createDataFrame([(i, t, la, s, None) for i, (la, s, t) in enumerate(rows)], DOCUMENTS)


@pytest.mark.parametrize("sources", [["a"], ["a", "b", None, ""], [f"s{i}" for i in range(75)]])
def test_against_plain(spark, sources):
    """One source, few, and more than two blocks of groups."""
    rows = made(len(sources), 300, sources)
    assert got(frame(spark, rows), top=20) == plain(rows, top=20)


def test_many_tiles(spark, monkeypatch):
    monkeypatch.setattr(A, "TILE", 7)
    rows = made(5, 200, ["a", "b", "c"])
    assert got(frame(spark, rows)) == plain(rows)


def test_given_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    assert got(df) == plain([(d["lang"], d["source"], d["text"]) for d in given("documents")])


def test_joint_traversal_counts_each_column_once():
    rng = np.random.default_rng(1)
    for trial in range(150):
        rows, columns = int(rng.integers(1, 12)), int(rng.integers(0, 40))
        more = int(rng.integers(0, 9))
        matrix = np.where(rng.random((rows, columns)) < rng.random(), rng.integers(1, 50, (rows, columns)), 0)
        sizes = (matrix.sum(axis=1) + max(columns + more, 1)).astype(np.int64)
        r, c = np.nonzero(matrix)
        codes = np.unique(c, return_inverse=True)[1] if len(c) else c
        split = None if trial % 2 or rows < 2 else int(rng.integers(1, rows))
        sums = A.pair_sums(r, codes.astype(np.int64), matrix[r, c].astype(np.int64), sizes, columns + more, split)
        full = np.concatenate([matrix, np.zeros((rows, more), dtype=np.int64)], axis=1).astype(object)
        p = 1 + 10**9 * (full + 1) // sizes[:, None].astype(object)
        for g in range(rows):
            for h in range(rows):
                if g != h and (split is None or (g < split) != (h < split)):
                    assert sums[g, h] == sum((a - b) ** 2 // b for a, b in zip(p[g], p[h]))


def test_weights_of_huge_counts(spark):
    """Products beyond 64 bits, in arrays and in columns."""
    counts, size = [0, 5, 10**15, 3 * 10**15], 4 * 10**15 + 7
    want = [1 + 10**9 * (c + 1) // size for c in counts]
    assert A._weights(np.array(counts), np.full(4, size)).tolist() == want
    df = spark.createDataFrame([(c,) for c in counts], "n long").select(A.weight(F.col("n"), F.lit(size)).alias("w"))
    assert [r.w for r in df.collect()] == want


def test_odd_rows(spark):
    rows = [("en", s, t) for _, t, s in ODD_ROWS]
    for df in (documents(spark, ODD_ROWS), widened(documents(spark, ODD_ROWS))):
        assert got(df) == plain(rows)
        assert got(df, least=1) == plain(rows, least=1)
    assert got(spark.createDataFrame([], DOCUMENTS)) == set()
    nothing = frame(spark, [(None, None, None), (None, "b", "1 2"), ("de", "b", None)])
    assert got(nothing) == {("", "", "pair", "b", 0, 1), ("", "b", "pair", "", 0, 1)}
