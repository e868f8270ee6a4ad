"""Helpers of more than one operator: word counts, hashes, broadcasts behind a check of size."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: The white space of the contracts: blank, tab, line feed, vertical tab, form feed, return.
BLANKS = " \t\n\x0b\f\r"
_BLANK_RUN = r"[\x20\x09-\x0D]+"

#: Bytes of an Arrow batch. A task holds several, in the JVM and in each Python worker.
ARROW_BYTES = 8 << 20

#: Odd constants for mixing 64-bit hashes.
_ODD = [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x7FB5D329728EA185, 0x81DADEF4BC2DD44D]


def word_count(text: Column) -> Column:
    """Number of ``[^\\x20\\x09-\\x0D]+`` in ``text``; 0 for null."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(BLANKS))
    words = F.size(F.split(trimmed, _BLANK_RUN))
    return F.when(trimmed == "", F.lit(0)).otherwise(words).cast("long")


def bounded(df: DataFrame, most_rows: int) -> DataFrame:
    """``df`` marked for broadcast if it has at most ``most_rows`` rows, else as it is.

    Give it small or staged frames: the check runs them.
    """
    held = df.limit(most_rows + 1).count()
    return F.broadcast(df) if held <= most_rows else df


def mix64(values: np.ndarray) -> np.ndarray:
    """A bijective scramble of unsigned 64-bit values."""
    out = values.astype(np.uint64, copy=True)
    out ^= out >> np.uint64(31)
    out *= np.uint64(_ODD[2])
    out ^= out >> np.uint64(27)
    out *= np.uint64(_ODD[3])
    out ^= out >> np.uint64(33)
    return out


class WordHashes(dict):
    """64-bit hash of each word, remembered for as many words of up to 64 bytes as stated."""

    def __init__(self, most: int = 100_000):
        super().__init__()
        self.most = most

    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh3_64_intdigest(word)
        if len(word) <= 64:
            if len(self) >= self.most:
                self.clear()
            self[word] = value
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), dtype=np.uint64, count=len(words))


def ordered_pair(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Hash of two hashes in their order."""
    return mix64(first * np.uint64(_ODD[0]) + mix64(second * np.uint64(_ODD[1]) + np.uint64(1)))


def column_batches(batches: Iterator, size: int) -> Iterator:
    """Arrow record batches cut to ``size`` rows, so that long texts stay few at once.

    A worker waits for its next task with the memory of the last one given back.
    """
    for batch in batches:
        for at in range(0, batch.num_rows, size):
            yield batch.slice(at, size)
    pa.default_memory_pool().release_unused()


def small_batches(spark: SparkSession) -> None:
    """From here on, the session's Arrow batches end at ``ARROW_BYTES``; Spark's default is eight times that."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BYTES))
