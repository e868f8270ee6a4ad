"""Benchmark passages in training documents, found by spaced-seed hashing.

Words are runs of letters, digits and underscores, in lower case. A mask such
as ``11010011`` hashes the words of a window at its ones and ignores the rest.
Hashes of all windows of the benchmark meet those of all windows of the
documents; around each hit the two texts are laid over each other without
gaps, and the longest stretch of at least ``LEAST_WORDS`` words with at
least 80 % of them equal counts as an overlap. The first mask hits every
stretch of 13 words with up to two substitutions, and the three together every
stretch of 13 to 24 words with up to a fifth of them substituted (enumerated in
the tests), so every such overlap is found. Benchmark items with fewer words must overlap as a whole, and have
hashes of their own: of runs so short that the allowed substitutions spare one.

The benchmark is a stated set: it comes in blocks of bounded size, each
broadcast to a scan of all documents.

Null or empty texts, on either side, overlap with nothing. Every row of the
documents is judged by itself, so repeated rows give repeated results;
repeated items count once. Items without id are left out of the results of
``overlaps`` but not of ``clean_documents``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from citelake.llm.common import WordHashes, column_batches, mix64, small_batches

MASKS = ("11010011", "1111001", "11100010111")
LEAST_WORDS = 13
#: Equal words of a hundred in an overlap.
PERCENT = 80
#: Characters and items of the benchmark in a block, on average.
BLOCK_CHARS, BLOCK_ITEMS = 32_000_000, 20_000
BATCH = 256

_WORD = re.compile(r"\w+")
_SCHEMA = "doc_id long, item_id long, matched long, length long, doc_start long, item_start long"
_BITS = 20


class Seeds(NamedTuple):
    """Windows of the items under one mask, sorted by hash."""

    offsets: np.ndarray
    span: int
    hashes: np.ndarray
    item: np.ndarray
    place: np.ndarray
    filter: np.ndarray


class Block(NamedTuple):
    ids: list
    words: list[np.ndarray]
    seeds: list[Seeds]


def words_of(text: str | None, hashes: WordHashes) -> np.ndarray:
    return hashes.of(_WORD.findall((text or "").lower()))


def spaced_hashes(words: np.ndarray, offsets: np.ndarray, span: int) -> np.ndarray:
    """The hash of every window of ``span`` words."""
    count = len(words) - span + 1
    if count <= 0:
        return np.empty(0, dtype=np.uint64)
    out = np.zeros(count, dtype=np.uint64)
    for n, offset in enumerate(offsets):
        out *= np.uint64(0x9E3779B97F4A7C15)
        out += words[offset : offset + count]
        if n == 0:
            out ^= out >> np.uint64(29)
    return mix64(out)


def _short_run(length: int) -> int:
    """Words in a row that are equal in any overlap with a whole item of this length."""
    changed = length * (100 - PERCENT) // 100
    return max(1, -(-(length - changed) // (changed + 1)))


def prepared(items: list[tuple[int, str]]) -> Block:
    """The items' words and the sorted hashes of their windows."""
    hashes = WordHashes()
    ids, words = [], []
    for item_id, text in items:
        got = words_of(text, hashes)
        if len(got):
            ids.append(item_id)
            words.append(got)
    whole = [i for i, w in enumerate(words) if len(w) >= LEAST_WORDS]
    wanted = [(np.array([n for n, c in enumerate(mask) if c == "1"]), len(mask), whole) for mask in MASKS]
    by_run: dict[int, list[int]] = {}
    for i, w in enumerate(words):
        if len(w) < LEAST_WORDS:
            by_run.setdefault(_short_run(len(w)), []).append(i)
    wanted += [(np.arange(run), run, some) for run, some in sorted(by_run.items())]
    seeds = []
    for offsets, span, some in wanted:
        made = [spaced_hashes(words[i], offsets, span) for i in some]
        if not made:
            continue
        values = np.concatenate(made)
        item = np.repeat(np.array(some), [len(m) for m in made])
        place = np.concatenate([np.arange(len(m)) for m in made])
        order = np.argsort(values, kind="stable")
        there = np.zeros(1 << _BITS, dtype=bool)
        there[values >> np.uint64(64 - _BITS)] = True
        seeds.append(Seeds(offsets, span, values[order], item[order], place[order], there))
    return Block(ids, words, seeds)


def longest_overlap(equal: np.ndarray, least: int) -> tuple[int, int]:
    """First and last place (exclusive) of the longest stretch with enough equal words; (0, 0) without one."""
    sums = np.concatenate([[0], np.cumsum(np.where(equal, 100 - PERCENT, -PERCENT))])
    lowest = np.minimum.accumulate(sums)
    starts = np.searchsorted(-lowest, -sums, side="left")
    lengths = np.arange(len(sums)) - starts
    end = int(np.argmax(lengths))
    return (int(starts[end]), end) if lengths[end] >= least else (0, 0)


def batch_overlaps(texts: list[str | None], block: Block, hashes: WordHashes) -> list[tuple]:
    """(row, item, matched, length, doc_start, item_start): the best overlap of each row with each item."""
    words = [words_of(text, hashes) for text in texts]
    ends = np.cumsum([len(w) for w in words])
    flat = np.concatenate(words) if words else np.empty(0, dtype=np.uint64)
    met = []
    for seed in block.seeds:
        values = spaced_hashes(flat, seed.offsets, seed.span)
        at = np.nonzero(seed.filter[values >> np.uint64(64 - _BITS)])[0]
        row = np.searchsorted(ends, at, side="right")
        inside = at + seed.span <= ends[row] if len(at) else np.zeros(0, bool)
        at, row = at[inside], row[inside]
        low = np.searchsorted(seed.hashes, values[at], side="left")
        times = np.searchsorted(seed.hashes, values[at], side="right") - low
        at, row, low = np.repeat(at, times), np.repeat(row, times), np.repeat(low, times)
        hit = low + np.arange(len(low)) - np.repeat(np.cumsum(times) - times, times)
        met.append(np.stack([row, seed.item[hit], at - seed.place[hit]], axis=1))
    if not met:
        return []
    best: dict[tuple[int, int], tuple] = {}
    for row, item, shift in np.unique(np.concatenate(met), axis=0).tolist():
        wanted = block.words[item]
        begin = ends[row] - len(words[row])
        first, last = max(begin, shift), min(ends[row], shift + len(wanted))
        equal = flat[first:last] == wanted[first - shift : last - shift]
        start, end = longest_overlap(equal, min(LEAST_WORDS, len(wanted)))
        if end:
            got = (int(equal[start:end].sum()), end - start, int(first + start - begin), int(first + start - shift))
            if got[:2] > best.get((row, item), (0, 0))[:2]:
                best[row, item] = got
    return [(row, item, *got) for (row, item), got in best.items()]


def _blocks(benchmark: DataFrame):
    """The benchmark's items in blocks, each on the driver for as long as it is broadcast."""
    items = benchmark.select(
        F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")
    ).where("text IS NOT NULL")
    held, chars = items.agg(F.count("*"), F.coalesce(F.sum(F.length("text")), F.lit(0))).first()
    count = max(1, -(-held // BLOCK_ITEMS), -(-chars // BLOCK_CHARS))
    for number in range(count):
        part = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(count)) == number)
        rows = sorted({tuple(r) for r in part.collect()}, key=str)
        yield benchmark.sparkSession.sparkContext.broadcast(prepared(rows))


def overlaps(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``doc_id, item_id, matched, length, doc_start, item_start`` of every document row that overlaps an item.

    ``matched`` of ``length`` words agree, from word ``doc_start`` of the
    document and ``item_start`` of the item on.
    """
    texts = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")
    )

    def found(held):
        def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            hashes, block = WordHashes(), held.value
            for batch in column_batches(batches, BATCH):
                got = batch_overlaps(batch.column(1).to_pylist(), block, hashes)
                got = [g for g in got if block.ids[g[1]] is not None]
                ids = batch.column(0).take(pa.array([g[0] for g in got], type=pa.int64()))
                rest = [pa.array([block.ids[g[1]] for g in got], type=pa.int64())]
                rest += [pa.array([g[i] for g in got], type=pa.int64()) for i in range(2, 6)]
                yield pa.RecordBatch.from_arrays(
                    [ids, *rest], names=["doc_id", "item_id", "matched", "length", "doc_start", "item_start"]
                )

        return find

    out = None
    for held in _blocks(benchmark):
        part = texts.mapInArrow(found(held), _SCHEMA)
        out = part if out is None else out.union(part)
    return out


def clean_documents(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``documents`` that overlap no item, with all their columns."""
    place = documents.columns.index("text")
    small_batches(documents.sparkSession)

    def kept(held):
        def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            hashes, block = WordHashes(), held.value
            for batch in column_batches(batches, BATCH):
                mask = np.ones(batch.num_rows, dtype=bool)
                mask[[g[0] for g in batch_overlaps(batch.column(place).to_pylist(), block, hashes)]] = False
                yield batch.filter(pa.array(mask))

        return keep

    for held in _blocks(benchmark):
        documents = documents.mapInArrow(kept(held), documents.schema)
    return documents
