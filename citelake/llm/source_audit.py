"""Divergence of sources within a language, over a K²-tree of the group-term count matrix.

A group is a (language, source) of the documents, a term a run of ASCII letters, lower-cased, and characters beyond
ASCII. A language keeps the terms in at least ``LEAST_DOCUMENTS`` of its documents. With ``N`` the group's occurrences
of kept terms and ``V`` the number of kept terms, a term with ``count`` occurrences weighs
``p = 1 + floor(10^9 * (count + 1) / (N + V))`` in the group, and ``q`` is the same over another source or the whole
language; a term's divergence is ``floor((p - q)^2 / q)``. All of it is whole-number arithmetic.

The matrix of a language (groups by terms) is cut into tiles of about ``TILE`` terms, by hash of the term, and
``ROWS`` groups; a task holds one tile for two blocks of groups, however large a language or a source is. Its nonzero
cells form a K²-tree with k = 2: each node says which of its four quadrants hold a cell at all. Pairs of groups go
down the tree together. Where a quadrant is empty for both row ranges, every pair in it has the same value for every
term, worked out once from the two empty weights and multiplied by the width; else the pairs go on to its halves, and
at single cells the weights are compared in both directions. The tiles' sums add up to the sum over all kept terms.

Null text, language and source read as ''. A group whose documents have no term still has all its pairs, as have
languages without kept terms (value 0). A language of one source has no pairs. Very long texts are one row's work;
repeated rows are documents of their own. Ties rank by item in UTF-8 order. An empty table gives no rows. Other
columns never matter.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from citelake.llm.common import bounded, column_batches
from citelake.llm.divergence import terms_of
from citelake.session import stage

LEAST_DOCUMENTS = 3
PARTS = 1_000_000_000
TOP = 200
#: Kept terms a tile holds on average; groups of a block.
TILE, ROWS = 2048, 32
#: Words counted in a task before the counts are passed on.
HELD = 400_000
BATCH = 256
#: Groups up to which they are broadcast; more are joined by shuffle.
BROADCAST_GROUPS = 100_000


# --------------------------------------------------------------------- counts

def _term_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``lang, source, term, n, docs`` summed over a stretch of documents."""
    counts: dict[tuple[str, str], tuple[Counter, Counter]] = {}
    size = 0

    def emit() -> Iterator[pa.RecordBatch]:
        for (lang, source), (n, docs) in counts.items():
            words = list(n)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([lang] * len(words), pa.string()),
                    pa.array([source] * len(words), pa.string()),
                    pa.array(words, pa.binary()).cast(pa.string()),
                    pa.array(list(n.values()), pa.int64()),
                    pa.array([docs[w] for w in words], pa.int64()),
                ],
                names=["lang", "source", "term", "n", "docs"],
            )

    for batch in batches:
        for part in column_batches([batch], BATCH):
            for lang, source, text in zip(*(c.to_pylist() for c in part.columns)):
                terms = terms_of(text)
                n, docs = counts.setdefault((lang, source), (Counter(), Counter()))
                size -= len(n)
                n.update(terms)
                docs.update(set(terms))
                size += len(n)
            if size > HELD:
                yield from emit()
                counts.clear()
                size = 0
    yield from emit()


def _text(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def kept_cells(documents: DataFrame, least: int = LEAST_DOCUMENTS) -> DataFrame:
    """``lang, source, term, n, lang_n, first``: the nonzero cells of kept terms; ``first`` marks one cell a term.

    Counts are summed in the tasks that read the texts, so a frequent term has one row a task and source. One
    shuffle, by term, serves both sums.
    """
    texts = documents.select(_text("lang").alias("lang"), _text("source").alias("source"), _text("text").cast("binary"))
    found = texts.mapInArrow(_term_counts, "lang string, source string, term string, n long, docs long")
    term = Window.partitionBy("lang", "term")
    return (
        found.repartition("lang", "term")
        .groupBy("lang", "term", "source")
        .agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
        .select(
            "lang", "source", "term", "n",
            F.sum("docs").over(term).alias("_docs"),
            F.sum("n").over(term).alias("lang_n"),
            (F.row_number().over(term.orderBy("source")) == 1).alias("first"),
        )
        .where(F.col("_docs") >= least)
        .drop("_docs")
    )


def with_weights(documents: DataFrame, cells: DataFrame) -> DataFrame:
    """One row a group: ``lang, source, place`` (within the language), ``size, lang_size`` (N + V of both), ``terms`` (V)."""
    langs = cells.groupBy("lang").agg(
        F.sum(F.col("first").cast("long")).alias("terms"), F.sum("n").alias("lang_n")
    )
    groups = documents.select(_text("lang").alias("lang"), _text("source").alias("source")).distinct()
    sums = cells.groupBy("lang", "source").agg(F.sum("n").alias("n"))
    terms = F.coalesce("terms", F.lit(0))
    place = F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1
    return (
        groups.join(sums, ["lang", "source"], "left").join(langs, "lang", "left").select(
            "lang", "source", place.cast("long").alias("place"),
            (F.coalesce("n", F.lit(0)) + terms).alias("size"),
            (F.coalesce("lang_n", F.lit(0)) + terms).alias("lang_size"),
            terms.alias("terms"),
        )
    )


def weight(n: Column, size: Column) -> Column:
    """``1 + floor(10^9 * (n + 1) / size)``, exact for counts of any size."""
    count = (n + 1).cast("decimal(20,0)") * F.lit(PARTS).cast("decimal(10,0)")
    return F.call_function("div", count, size.cast("decimal(20,0)")) + 1


# ---------------------------------------------------------------------- K²-tree

class Level(NamedTuple):
    """The nodes of one level: which quadrants hold a cell, and the index of the first such one on the next level."""

    held: np.ndarray  # nodes by 4: (row half, column half) in order
    first: np.ndarray


class Tree(NamedTuple):
    levels: list[Level]
    side: int
    cells: np.ndarray  # for each node below the last level, the cell it is


def k2_tree(rows: np.ndarray, columns: np.ndarray, side: int) -> Tree:
    """The tree over distinct cells (row, column) of a square matrix; ``side`` is a power of 2."""
    depth = side.bit_length() - 1
    codes = np.zeros(len(rows), dtype=np.int64)
    for bit in range(depth - 1, -1, -1):
        codes = codes << 2 | (rows >> bit & 1) << 1 | (columns >> bit & 1)
    order = np.argsort(codes, kind="stable")
    codes = codes[order]
    levels = []
    for level in range(depth):
        below = np.unique(codes >> 2 * (depth - level - 1))
        nodes, of = np.unique(below >> 2, return_inverse=True)
        held = np.zeros((len(nodes), 4), dtype=bool)
        held[of, below & 3] = True
        first = np.concatenate([[0], np.cumsum(held.sum(axis=1))[:-1]]).astype(np.int64)
        levels.append(Level(held, first))
    return Tree(levels, side, order)


def _child(level: Level, nodes: np.ndarray, quadrant: int) -> np.ndarray:
    """The index on the next level of every node's quadrant; -1 where the node is -1 or the quadrant empty."""
    if not len(level.held):
        return np.full(len(nodes), -1)
    at = np.maximum(nodes, 0)
    place = level.first[at] + level.held[at, :quadrant].sum(axis=1)
    return np.where((nodes >= 0) & level.held[at, quadrant], place, -1)


class Joint(NamedTuple):
    """Pairs of groups at single cells, and for every pair the number of columns empty for both."""

    left: np.ndarray
    right: np.ndarray
    left_cell: np.ndarray  # -1 where empty
    right_cell: np.ndarray
    empty: np.ndarray


def traverse(tree: Tree, rows: int, columns: int, split: int | None) -> Joint:
    """All pairs of rows ``left < right`` down the tree together; with ``split`` only left below it and right from it on."""
    root = 0 if tree.levels and len(tree.levels[0].held) else -1
    left, right = np.array([root]), np.array([root])
    top_l, top_r, col = np.zeros(1, np.int64), np.zeros(1, np.int64), np.zeros(1, np.int64)
    corners = np.zeros((rows + 1, rows + 1), dtype=np.int64)
    half = tree.side

    def price(at: np.ndarray, a: np.ndarray, b: np.ndarray, c: np.ndarray, size: int) -> None:
        """Count the columns of empty quadrants for all pairs of their row ranges, by the ranges' corners."""
        width = np.minimum(c[at] + size, columns) - c[at]
        a0, b0 = a[at], b[at]
        a1, b1 = np.minimum(a0 + size, rows), np.minimum(b0 + size, rows)
        for r, s, sign in ((a0, b0, 1), (a1, b0, -1), (a0, b1, -1), (a1, b1, 1)):
            np.add.at(corners, (r, s), sign * width)

    for level in tree.levels:
        half >>= 1
        parts = []
        for i in (0, 1):
            for j in (0, 1):
                for k in (0, 1):
                    a, b, c = top_l + i * half, top_r + j * half, col + k * half
                    there = (a < rows) & (b < rows) & (c < columns) & (a <= b)
                    if split is not None:
                        there &= (a < split) & (b + half > split)
                    x, y = _child(level, left[there], 2 * i + k), _child(level, right[there], 2 * j + k)
                    a, b, c = a[there], b[there], c[there]
                    none = (x < 0) & (y < 0)
                    price(none, a, b, c, half)
                    parts.append([v[~none] for v in (x, y, a, b, c)])
        left, right, top_l, top_r, col = (np.concatenate(v) for v in zip(*parts))
    empty = corners.cumsum(axis=0).cumsum(axis=1)[:rows, :rows]
    cells = np.concatenate([tree.cells, [-1]])
    apart = top_l < top_r
    return Joint(top_l[apart], top_r[apart], cells[left[apart]], cells[right[apart]], empty)


def _weights(counts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """``weight`` in arrays: 10^9 as three steps of 1000, so that nothing exceeds 64 bits."""
    rest, whole = counts + 1, np.zeros_like(counts)
    for _ in range(3):
        rest = rest * 1000
        whole = whole * 1000 + rest // sizes
        rest = rest % sizes
    return whole + 1


def pair_sums(
    rows: np.ndarray, columns: np.ndarray, counts: np.ndarray, sizes: np.ndarray, n_columns: int, split: int | None = None
) -> np.ndarray:
    """``sums[g, h]`` of the divergence of row g from row h over ``n_columns`` columns, of which ``columns`` names the used ones."""
    used = int(columns.max()) + 1 if len(columns) else 0
    side = 1
    while side < max(len(sizes), used, 2):
        side *= 2
    joint = traverse(k2_tree(rows, columns, side), len(sizes), used, split)
    none = _weights(np.zeros_like(sizes), sizes)
    own = np.concatenate([_weights(counts, sizes[rows]), [0]])
    p = np.where(joint.left_cell >= 0, own[joint.left_cell], none[joint.left])
    q = np.where(joint.right_cell >= 0, own[joint.right_cell], none[joint.right])
    square = (p - q) ** 2
    sums = np.zeros((len(sizes), len(sizes)), dtype=np.int64)
    np.add.at(sums, (joint.left, joint.right), square // q)
    np.add.at(sums, (joint.right, joint.left), square // p)
    empty = np.triu(joint.empty + (n_columns - used), 1)
    empty = empty + empty.T
    return sums + (none[:, None] - none[None, :]) ** 2 // none[None, :] * empty


# ----------------------------------------------------------------------- parts

_KEYS = ["lang", "tile", "a", "b"]


def _tile_sums(cells: pa.Table, task: pa.Table) -> pa.Table:
    """One tile of two blocks of groups: ``lang, i, j, value``, the tile's part of the sums."""
    schema = pa.schema([("lang", pa.string()), ("i", pa.int64()), ("j", pa.int64()), ("value", pa.int64())])
    if not task.num_rows:
        return schema.empty_table()
    (row,) = task.to_pylist()
    blocks = [(row["a"], row["a_sizes"])] + ([(row["b"], row["b_sizes"])] if row["a"] != row["b"] else [])
    places = np.concatenate([ROWS * block + np.arange(len(held)) for block, held in blocks])
    sizes = np.concatenate([np.array(held, dtype=np.int64) for _, held in blocks])
    split = len(blocks[0][1]) if len(blocks) > 1 else None
    place = cells["place"].to_numpy()
    rows = np.searchsorted(places, place)
    columns = cells["term"].combine_chunks().dictionary_encode().indices.to_numpy().astype(np.int64)
    sums = pair_sums(rows, columns, cells["n"].to_numpy(), sizes, row["n_terms"], split)
    left, right = np.nonzero(~np.eye(len(sizes), dtype=bool))
    if split is not None:
        across = (left < split) != (right < split)
        left, right = left[across], right[across]
    return pa.table(
        [pa.array([row["lang"]] * len(left), pa.string()), places[left], places[right], sums[left, right]], schema=schema
    )


def pair_values(cells: DataFrame, groups: DataFrame) -> DataFrame:
    """``lang, i, j, value`` for pairs of groups of languages with kept terms. ``cells`` and ``groups`` are staged."""
    held = bounded(groups.select("lang", "source", "place", "terms"), BROADCAST_GROUPS)
    tiles = F.ceil(F.col("terms") / TILE)
    tile = F.pmod(F.xxhash64("term"), tiles)
    placed = cells.join(held, ["lang", "source"]).withColumn("tile", tile.cast("long"))
    widths = placed.where("first").groupBy("lang", "tile").agg(F.count("*").alias("n_terms"))
    blocks = (
        groups.withColumn("block", F.expr(f"place div {ROWS}"))
        .groupBy("lang", "block")
        .agg(F.sort_array(F.collect_list(F.struct("place", "size"))).getField("size").alias("sizes"))  # ROWS at most
    )
    tasks = (
        widths.join(blocks.select("lang", F.col("block").alias("a"), F.col("sizes").alias("a_sizes")), "lang")
        .join(blocks.select("lang", F.col("block").alias("b"), F.col("sizes").alias("b_sizes")), "lang")
        .where("a <= b")
    )
    counts = bounded(blocks.groupBy("lang").agg(F.count("*").alias("n_blocks")), BROADCAST_GROUPS)
    own = F.expr(f"place div {ROWS}")
    dealt = (
        placed.join(counts, "lang")
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("n_blocks") - 1)))
        .select(
            "lang", "tile", F.least(own, "other").alias("a"), F.greatest(own, "other").alias("b"), "place", "term", "n"
        )
    )
    # Both sides come from one table: the columns of one get identities of their own.
    tasks = tasks.select(*[F.col(c).alias(c) for c in tasks.columns])
    sums = dealt.groupBy(*_KEYS).cogroup(tasks.groupBy(*_KEYS)).applyInArrow(
        _tile_sums, "lang string, i long, j long, value long"
    )
    return sums.groupBy("lang", "i", "j").agg(F.sum("value").alias("value"))


def source_audit(documents: DataFrame, least: int = LEAST_DOCUMENTS, top: int = TOP) -> DataFrame:
    """``lang, source, part, item, value, rank``: the divergence of every group from each other source of its language
    (part ``pair``, all ranks), and the terms it uses more than its language does (part ``term``, ranks to ``top``).
    """
    cells = stage(kept_cells(documents, least), "audit-cells")
    groups = stage(with_weights(documents, cells), "audit-groups")
    best = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    ranked = ["lang", "source", "part", "item", "value", F.row_number().over(best).alias("rank")]

    first = groups.select("lang", "source", F.col("place").alias("i"))
    second = groups.select("lang", F.col("source").alias("item"), F.col("place").alias("j"))
    pairs = (
        first.join(second, "lang").where("i <> j")
        .join(pair_values(cells, groups), ["lang", "i", "j"], "left")
        .select("lang", "source", F.lit("pair").alias("part"), "item", F.coalesce("value", F.lit(0)).alias("value"))
    )
    p, q = F.col("p"), F.col("q")
    terms = (
        cells.join(bounded(groups.select("lang", "source", "size", "lang_size"), BROADCAST_GROUPS), ["lang", "source"])
        .select(
            "lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"),
            weight(F.col("n"), F.col("size")).alias("p"), weight(F.col("lang_n"), F.col("lang_size")).alias("q"),
        )
        .where(p > q)
        .withColumn("value", F.call_function("div", (p - q) * (p - q), q))
    )
    return pairs.select(*ranked).unionByName(terms.select(*ranked).where(F.col("rank") <= top))
