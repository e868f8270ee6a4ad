"""Exact top-k by inner product of quantised vectors.

A component x becomes floor(256 * x). A vector is cut into segments at several
resolutions; with the mean and the deviation of each segment, Cauchy-Schwarz
bounds the inner product of two vectors from above (their distance from
below): the sum over segments of length * (mean * mean + deviation *
deviation). Pairs whose bound at a coarse resolution is below the query's
k-th best score so far are dropped before the finer ones; survivors get their
exact product.

Queries come in blocks of bounded size, each broadcast to a scan of all
candidates. Every task returns at most k rows per query, none below the k-th
score that the block's queries reach among themselves.

Vectors that are null, empty or hold null or non-finite components take no part;
nor do rows without id. A query meets vectors of its own length only, never rows of its own
id. Repeated rows of one id and vector count once; of several vectors under
one id, all are candidates, and the least in array order is the query. Ties go
to the smaller id. Scores beyond 64 bits stop at the largest or smallest long.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from citelake.session import stage

K = 5
#: Mean number of queries in a block, and segments of each resolution.
BLOCK = 4096
RESOLUTIONS = (1, 8, 32)
#: Candidates compared at once, and survivors multiplied at once.
CHUNK = 1024
PAIRS = 200_000

_SCHEMA = "query_id long, vec_id long, score long"
#: Products of components below this stay exact in doubles for vectors of up to 2^11 components.
_SAFE = 1 << 21


def quantised(vectors: DataFrame) -> DataFrame:
    """``vec_id, v`` of the vectors that take part."""
    sound = F.forall(
        "embedding",
        lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")),
    )
    return (
        vectors.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull())
        .where((F.size("embedding") > 0) & sound)
        .select(
            F.col("vec_id").cast("long").alias("vec_id"),
            F.transform("embedding", lambda x: F.floor(x.cast("double") * 256.0).cast("double")).alias("v"),
        )
    )


def segments(v: np.ndarray, count: int) -> np.ndarray:
    """Means and deviations of ``count`` segments, scaled so that the dot product of two rows is the bound."""
    d = v.shape[1]
    edges = np.unique(np.linspace(0, d, min(count, d) + 1).astype(int))
    sizes = np.diff(edges)
    mean = np.add.reduceat(v, edges[:-1], axis=1) / sizes
    square = np.add.reduceat(v * v, edges[:-1], axis=1) / sizes
    deviation = np.sqrt(np.maximum(square - mean * mean, 0))
    return np.hstack([mean, deviation]) * np.sqrt(np.hstack([sizes, sizes]))


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of rows, kept within a long."""
    if max(np.abs(a).max(initial=0), np.abs(b).max(initial=0)) < _SAFE:
        return np.einsum("ij,ij->i", a, b).astype(np.int64)
    low, high = -(1 << 63), (1 << 63) - 1
    exact = [sum(int(x) * int(y) for x, y in zip(p, q)) for p, q in zip(a, b)]
    return np.array([min(max(s, low), high) for s in exact], dtype=np.int64)


class Block:
    """Queries of one length, with the best scores met so far."""

    def __init__(self, ids: np.ndarray, v: np.ndarray, k: int):
        self.ids, self.v, self.k = ids, v, k
        self.levels = [segments(v, n) for n in RESOLUTIONS]
        self.best = np.full((len(ids), k), -np.inf)
        self.slack = 1 + 1e-9 * np.abs(v).max(initial=0) ** 2 * v.shape[1]
        self.found: list[tuple] = []

    def start(self) -> None:
        """Thresholds from the queries' products with each other, which are candidates too."""
        if len(self.ids) > self.k and np.abs(self.v).max() < _SAFE:
            for at in range(0, len(self.ids), CHUNK):
                scores = self.v[at : at + CHUNK] @ self.v.T
                scores[self.ids[at : at + CHUNK, None] == self.ids[None, :]] = -np.inf
                self.best[at : at + CHUNK] = -np.sort(-scores, axis=1)[:, : self.k]
        self.floor = self.best[:, -1].copy()

    def meet(self, ids: np.ndarray, v: np.ndarray) -> None:
        """Compare every candidate of a chunk; keep those that can be among the k best."""
        floor = self.best[:, -1]
        slack = self.slack + 1e-9 * np.abs(v).max(initial=0) ** 2 * v.shape[1]
        alive = self.ids[:, None] != ids[None, :]
        for queries, count in zip(self.levels, RESOLUTIONS):
            alive &= queries @ segments(v, count).T >= (floor - slack)[:, None]
        rows, columns = np.nonzero(alive)
        for at in range(0, len(rows), PAIRS):
            q, c = rows[at : at + PAIRS], columns[at : at + PAIRS]
            scores = products(self.v[q], v[c])
            keep = scores >= floor[q]
            if keep.any():
                self.found.append((q[keep], ids[c[keep]], scores[keep]))
        self.settle()

    def settle(self) -> None:
        """Reduce what was found to k rows a query, and raise the thresholds."""
        if not self.found:
            return
        q, c, s = (np.concatenate(x) for x in zip(*self.found))
        rows = pd.DataFrame({"q": q, "c": c, "s": s}).drop_duplicates()
        rows = rows.sort_values(["q", "s", "c"], ascending=[True, False, True])
        rows = rows[rows.groupby("q").cumcount() < self.k]
        self.found = [(rows.q.to_numpy(), rows.c.to_numpy(), rows.s.to_numpy())]
        last = rows[rows.groupby("q").cumcount() == self.k - 1]
        at = last.q.to_numpy()
        self.best[at, -1] = np.maximum(self.best[at, -1], last.s.to_numpy())

    def rows(self) -> pd.DataFrame:
        q, c, s = self.found[0] if self.found else (np.empty(0, int),) * 3
        return pd.DataFrame({"query_id": self.ids[q], "vec_id": c, "score": s}).astype("int64")


def _blocks(rows: list[tuple[int, list[float]]], k: int) -> list[Block]:
    """Queries by length of vector."""
    by_length: dict[int, list] = {}
    for row in rows:
        by_length.setdefault(len(row[1]), []).append(row)
    made = [Block(np.array([i for i, _ in some]), np.array([v for _, v in some]), k) for some in by_length.values()]
    for block in made:
        block.start()
    return made


def exact_top_k(vectors: DataFrame, queries: DataFrame, k: int = K, block: int = BLOCK) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k best of ``vectors`` for every row of ``queries``.

    Both have ``vec_id, embedding``.
    """
    spark = vectors.sparkSession
    candidates = quantised(vectors)
    asked = stage(quantised(queries).groupBy("vec_id").agg(F.min("v").alias("v")), "top-k-queries")
    blocks = max(1, -(-asked.count() // block))
    of = F.pmod(F.xxhash64("vec_id"), F.lit(blocks))

    def searched(held):
        def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            made = {b.v.shape[1]: b for b in _blocks(held.value, k)}
            for batch in batches:
                lengths = batch["v"].map(len).to_numpy()
                for length in np.unique(lengths):
                    if length in made:
                        some = batch[lengths == length]
                        ids, v = some["vec_id"].to_numpy(), np.stack(some["v"].to_numpy())
                        for at in range(0, len(ids), CHUNK):
                            made[length].meet(ids[at : at + CHUNK], v[at : at + CHUNK])
            for one in made.values():
                yield one.rows()

        return search

    found = None
    for number in range(blocks):
        rows = [(r.vec_id, r.v) for r in asked.where(of == number).collect()]
        part = candidates.mapInPandas(searched(spark.sparkContext.broadcast(rows)), _SCHEMA)
        if blocks > 1:
            part = stage(part, "top-k-block")
        found = part if found is None else found.union(part)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        found.distinct()
        .withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
