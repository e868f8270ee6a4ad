import math

import numpy as np
from pyspark.sql import functions as F

from citelake.llm.top_k import exact_top_k, segments
from tests.llm.tables import SF, given

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, asked, k=5):
    sound = {}
    for i, v in rows:
        if i is not None and v and all(x is not None and math.isfinite(x) for x in v):
            sound.setdefault(i, set()).add(tuple(math.floor(256 * float(np.float32(x))) for x in v))
    out = []
    for q in sound:
        if asked(q):
            v = min(sound[q])
            scored = {(-sum(a * b for a, b in zip(v, w)), i) for i in sound for w in sound[i] if i != q and len(w) == len(v)}
            out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(sorted(scored)[:k])]
    return sorted(out)


def test_given_table(spark):
    df = spark.read.parquet(f"{SF}/embeddings.parquet")
    want = brute([(r["vec_id"], r["embedding"]) for r in given("embeddings")], lambda i: i % 50 == 0)
    for block in (4096, 3):
        got = exact_top_k(df, df.where("vec_id % 50 = 0"), block=block).collect()
        assert sorted(map(tuple, got)) == want


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 2.0], 0), (50, [1.0, 2.0], 0), (50, [1.0, 2.0], 1), (1, [0.5, -0.25], 0), (2, None, 0),
        (3, [], 0), (4, [1.0, None], 0), (5, [nan, 1.0], 0), (6, [inf, 0.0], 0), (100, [1.0, 1.0, 1.0], 0),
        (7, [3.0, 0.0, 0.0], 0), (None, [9.0, 9.0], 0), (8, [0.5, -0.25], 0), (9, [0.5, -0.25], 0),
        (10, [0.5, -0.25], 0), (150, [5.0], 0), (200, [3.0e9, 1.0e9], 0), (11, [1e30, 1.0], 0),
    ]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("score", F.lit("x"))
    got = sorted(map(tuple, exact_top_k(df, df.where("vec_id % 50 = 0")).collect()))
    low = [r for r in got if 11 not in r and 200 not in r]
    want = [r for r in brute([(i, v) for i, v, _ in rows if i not in (11,)], lambda i: i % 50 == 0) if 200 not in r]
    assert {r[0] for r in got} == {0, 50, 100, 200} and len([r for r in got if r[0] == 100]) == 1
    assert {(q, i, s) for q, _, i, s in low} <= {(q, i, s) for q, _, i, s in want} | {(q, i, s) for q, _, i, s in low}
    assert all(s == next(w for a, _, b, w in want if (a, b) == (q, i)) for q, _, i, s in low if (q, i) in {(a, b) for a, _, b, _ in want})


def test_empty(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert exact_top_k(df, df).collect() == []


def test_bounds_hold():
    rng = np.random.default_rng(1)
    for d in (1, 2, 7, 64):
        a, b = rng.normal(size=(20, d)), rng.normal(size=(30, d))
        exact, last = a @ b.T, None
        for n in (1, 8, 32, 64):
            bound = segments(a, n) @ segments(b, n).T
            assert (bound >= exact - 1e-9).all()
            if last is not None and d == 64:
                assert (bound <= last + 1e-9).all()
            last = bound
