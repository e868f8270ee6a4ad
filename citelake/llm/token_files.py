"""Token ids of documents in ORC files.

Rows lie in ascending document order over the files, one row per document:
``doc_id, part, at, n_tokens, ids`` with ``part`` the number of the file's
range, ``at`` the ids of the documents before it in that range, and ``ids``
ending with the end id. ORC stores the integers with run-length encoding in
stripes, which readers take in parallel; row indexes and a Bloom filter on
``doc_id`` let ``read_documents`` pass over stripes and row groups without a
wanted document.

A text is encoded in pieces cut where a word ends before white space. The
pre-tokenizer of byte-level BPE never joins text across such a place, so the
ids are those of the whole text, and a repeated piece need not be encoded again.

Null texts count as empty: one end id. Null ids come first; rows with equal
ids follow each other by the hash of their text, equal rows in any order. An
empty table gives an empty folder of files and no rows. Texts are encoded
whole, whatever their length.
"""

from __future__ import annotations

import os
import re
import sys
import types
import zlib
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from citelake.llm.common import bounded, column_batches, small_batches

TOKENIZER = "byte_bpe_50k.json"
END_ID = 0
#: Bytes in a generation of the pieces whose ids a process remembers, and of a piece besides its text and ids.
CACHE_BYTES, PIECE_BYTES = 24 << 20, 200
#: Documents encoded at once.
BATCH = 512

FILE_SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("part", T.IntegerType()),
        T.StructField("at", T.LongType()),
        T.StructField("n_tokens", T.LongType()),
        T.StructField("ids", T.ArrayType(T.IntegerType())),
    ]
)

#: White space as the pre-tokenizer knows it: Python's without the four separators.
_SPACE = r"[^\S\x1c-\x1f]"
_PIECE = re.compile(rf"{_SPACE}*(?:\S|[\x1c-\x1f])+|{_SPACE}+")
#: Punctuation behind letters: the pre-tokenizer cuts between the two.
_CLOSING = ".,;:!?"
#: A blank beside other white space or at the end: then cutting at single blanks is not enough.
_IRREGULAR = re.compile(r" \s|\s | \Z")
#: White space of ASCII besides blank and line feed.
_UNUSUAL = "\t\r\x0b\x0c\x1c\x1d\x1e\x1f"


def tokenizer_path(name: str = TOKENIZER) -> str:
    """Where the installed vocabulary file of that name lies."""
    import public_tokenizers

    return public_tokenizers.path(name)


def pieces_of(text: str) -> list[str]:
    """Pieces whose encodings, one after another, are the encoding of ``text``."""
    if not text.isascii() or any(c in text for c in _UNUSUAL):
        irregular = _IRREGULAR.search(text) is not None
    else:
        irregular = "  " in text or " \n" in text or "\n " in text or text.endswith(" ")
    if irregular:
        return _PIECE.findall(text)
    first, *rest = text.split(" ")
    return ([first] if first else []) + [" " + word for word in rest]


class Encoder:
    """Texts to ids, the end id last, as little-endian 32-bit integers.

    Pieces are remembered in two generations: when the younger has ``most`` bytes it
    becomes the elder, whose pieces come back as they occur again. A new piece of
    letters and closing punctuation is put together from its two halves. New
    words with a blank before them are encoded many at once, one a line: the
    line feed between them is a token of its own.
    """

    def __init__(self, vocabulary: str, end_id: int = END_ID, most: int = CACHE_BYTES):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(vocabulary)
        self.end = np.array([end_id], dtype="<u4").tobytes()
        self.most, self.held = most, 0
        self.young: dict[str, bytes] = {}
        self.elder: dict[str, bytes] = {}
        self.line = self._ids(["\n"])[0]

    def _ids(self, texts: list[str]) -> list[list[int]]:
        return [got.ids for got in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _encode_new(self, new: list[str]) -> dict[str, bytes]:
        """The ids of pieces not met before."""
        out: dict[str, bytes] = {}
        lines = [piece for piece in new if piece[0] == " " and piece[1:].isalpha()]
        for at in range(0, len(lines) if len(self.line) == 1 else 0, 500):
            some = lines[at : at + 500]
            ids = np.array(self._ids(["\n".join(some)])[0], dtype="<u4")
            ends = np.nonzero(ids == self.line[0])[0].tolist()
            if len(ends) == len(some) - 1:
                raw, begin = ids.tobytes(), 0
                for piece, end in zip(some, [*ends, len(ids)]):
                    out[piece] = raw[4 * begin : 4 * end]
                    begin = end + 1
        rest = [piece for piece in new if piece not in out]
        for at in range(0, len(rest), 5000):
            some = rest[at : at + 5000]
            for piece, ids in zip(some, self._ids(some)):
                out[piece] = np.array(ids, dtype="<u4").tobytes()
        return out

    def _meet(self, pieces: set[str]) -> None:
        """Have all these pieces in the younger generation."""
        new = pieces - self.young.keys()
        if new and self.held > self.most:
            self.elder, self.young, self.held, new = self.young, {}, 0, pieces
        young, elder = self.young, self.elder
        before = len(young)
        halves, missing = [], set()
        for piece in new:
            ids = elder.get(piece)
            if ids is not None:
                young[piece] = ids
                continue
            word = piece.rstrip(_CLOSING)
            if word is not piece and (word[1:] if word[:1] == " " else word).isalpha():
                halves.append((piece, word, piece[len(word) :]))
            else:
                missing.add(piece)
        for _, word, mark in halves:
            for part in (word, mark):
                if part not in young:
                    ids = elder.get(part)
                    if ids is None:
                        missing.add(part)
                    else:
                        young[part] = ids
        young.update(self._encode_new(list(missing)))
        for piece, word, mark in halves:
            young[piece] = young[word] + young[mark]
        self.held += sum(PIECE_BYTES + len(p) + len(ids) for p, ids in islice(young.items(), before, None))

    def __call__(self, texts: list[str]) -> list[bytes]:
        cut = [pieces_of(text) for text in texts]
        self._meet(set().union(*cut))
        return [b"".join(map(self.young.__getitem__, pieces)) + self.end for pieces in cut]


def encoder(vocabulary: str, end_id: int = END_ID) -> Encoder:
    """The encoder of this process: a worker's next tasks find the pieces of those before."""
    held = sys.modules.setdefault("_token_encoders", types.ModuleType("_token_encoders")).__dict__
    key = f"{vocabulary} {end_id}"
    if key not in held:
        held[key] = Encoder(vocabulary, end_id)
    return held[key]


def write_tokens(
    documents: DataFrame, path: str, vocabulary: str | None = None, end_id: int = END_ID
) -> None:
    """Encode ``doc_id, text`` and write the files below ``path``, which must not exist."""
    vocabulary = vocabulary or tokenizer_path()
    small_batches(documents.sparkSession)

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary, end_id)
        part, at = TaskContext.get().partitionId(), 0
        for batch in column_batches(batches, BATCH):
            texts = [text or "" for text in batch.column(1).to_pylist()]
            coded = encode(texts)
            counts = np.array([len(one) // 4 for one in coded], dtype=np.int64)
            ends = np.cumsum(counts)
            offsets = np.concatenate([[0], ends]).astype(np.int32)
            ids = pa.ListArray.from_arrays(
                pa.array(offsets), pa.array(np.frombuffer(b"".join(coded), dtype="<i4"))
            )
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(np.full(len(texts), part, dtype=np.int32)),
                    pa.array(at + ends - counts),
                    pa.array(counts),
                    ids,
                ],
                names=FILE_SCHEMA.names,
            )
            at += int(ends[-1])

    tie = F.xxhash64("text")
    (
        documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
        .repartitionByRange(F.col("doc_id").asc_nulls_first(), tie)
        .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), tie)
        .mapInArrow(encoded, FILE_SCHEMA)
        .write.option("orc.bloom.filter.columns", "doc_id")
        .option("orc.bloom.filter.fpp", "0.01")
        .option("orc.create.index", "true")
        .option("orc.row.index.stride", "1000")
        .option("orc.stripe.size", str(32 << 20))
        .option("compression", "zstd")
        .orc(path)
    )


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """The rows of the files, in stripes read side by side."""
    return spark.read.schema(FILE_SCHEMA).orc(path)


def read_documents(spark: SparkSession, path: str, doc_ids: list[int]) -> DataFrame:
    """The rows of some documents; indexes and Bloom filters prune the rest of the files."""
    return read_tokens(spark, path).where(F.col("doc_id").isin(doc_ids))


def token_index(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` from the ids in the files.

    ``start`` counts the ids of all documents before: those of the range
    (``at``) and of the ranges before, whose totals are one row per file.
    """

    def checked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(3)
            bounds = lists.offsets.to_numpy()
            values = lists.values.to_numpy().astype("<u4", copy=False)
            sums = [zlib.crc32(values[a:b].tobytes()) for a, b in zip(bounds, bounds[1:])]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    batch.column(2),
                    pa.array(np.diff(bounds).astype(np.int64)),
                    pa.array(sums, type=pa.int64()),
                ],
                names=["doc_id", "part", "at", "n_tokens", "ids_crc32"],
            )

    files = read_tokens(spark, path)
    rows = files.select("doc_id", "part", "at", "ids").mapInArrow(
        checked, "doc_id long, part int, at long, n_tokens long, ids_crc32 long"
    )
    ranges = files.groupBy("part").agg(F.max(F.col("at") + F.col("n_tokens")).alias("held"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = ranges.select("part", F.coalesce(F.sum("held").over(before), F.lit(0)).alias("base"))
    return rows.join(bounded(starts, 100_000), "part").select(
        "doc_id", (F.col("base") + F.col("at")).alias("start"), "n_tokens", "ids_crc32"
    )
