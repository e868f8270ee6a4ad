"""Checks on downloaded files."""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from citelake.functions.text import jtrim
from citelake.session import small_batches


def expected_md5(checksum: Column) -> Column:
    """The hash a sidecar names: the text after ``=``, or 32 hex digits followed
    by a blank. NULL when it has neither form.
    """
    text = jtrim(checksum)
    after_sign = jtrim(F.split_part(text, F.lit("="), F.lit(2)))
    leading = F.regexp_extract(text, r"\A([a-fA-F0-9]{32})\s+.*\z", 1)
    found = F.when(text.contains("="), after_sign).otherwise(leading)
    return F.when(found != "", found)


def verify_md5(files: DataFrame, sidecars: DataFrame) -> DataFrame:
    """``name, status``: ok, mismatch, no_sidecar or bad_format for every file.

    ``files`` has ``name`` and ``content`` or ``md5``; ``sidecars`` has ``name, checksum``. If both
    have ``path`` too, that is the key and is given out: files of one name may lie in several folders. Of
    several sidecars with one key the least text counts. Contents are
    reduced to their hash before the join.
    """
    key = "path" if "path" in files.columns and "path" in sidecars.columns else "name"
    kept = list(dict.fromkeys(["name", key]))
    actual = F.col("md5") if "md5" in files.columns else F.md5("content")
    hashed = files.select(*kept, actual.alias("actual"))
    sidecars = sidecars.groupBy(key).agg(F.min("checksum").alias("checksum"))
    expected = F.lower(expected_md5(F.col("checksum")))
    status = (
        F.when(F.col("checksum").isNull(), "no_sidecar")
        .when(expected.isNull(), "bad_format")
        .when(expected == F.col("actual"), "ok")
        .otherwise("mismatch")
    )
    return hashed.join(sidecars, key, "left").select(*kept, status.alias("status"))


def verified(statuses: DataFrame) -> DataFrame:
    """Names (and paths, if known) that may count as held."""
    return statuses.where(F.col("status") == "ok").drop("status")


def failed_files(statuses: DataFrame) -> DataFrame:
    """Quarantine rows of the files that did not pass ``verify_md5``."""
    return statuses.where(F.col("status") != "ok").select(
        F.col("path" if "path" in statuses.columns else "name").alias("source"),
        F.lit(None).cast("string").alias("doc_id"),
        F.lit("checksum").alias("stage"),
        F.col("status").alias("reason"),
    )


STEP = 1 << 20


def inflated(pieces: Iterable[bytes]) -> Iterator[bytes | str]:
    """The content of a gzip file, given in pieces, in pieces of up to 1 MiB; a text at the end says what is wrong with the file.

    Members may follow each other; bytes after the last one that start no new
    member are ignored.
    """
    member, held = zlib.decompressobj(wbits=31), b""
    for piece in pieces:
        held += piece
        while held:
            if member is None:
                if len(held) < 2:
                    break
                if held[:2] != b"\x1f\x8b":
                    return
                member = zlib.decompressobj(wbits=31)
            try:
                yield member.decompress(held, STEP)
                while member.unconsumed_tail and not member.eof:
                    yield member.decompress(member.unconsumed_tail, STEP)
            except zlib.error as error:
                yield str(error)
                return
            # What follows an ended member is the next one's, or nobody's.
            held = member.unused_data
            member = None if member.eof else member
    if member is not None:
        yield "unexpected end of file"


def sliced(data: bytes) -> Iterator[bytes]:
    for at in range(0, len(data), STEP):
        yield data[at : at + STEP]


def gzip_fault(pieces: Iterable[bytes]) -> str | None:
    """None when the pieces are a whole gzip file."""
    for piece in inflated(pieces):
        if isinstance(piece, str):
            return piece
    return None


def _gzip_fault(data: bytes) -> str | None:
    return gzip_fault(sliced(data))


def check_gzip(files: DataFrame) -> DataFrame:
    """``name, path, ok, reason`` for files given as ``name, path, content``."""

    small_batches(files.sparkSession)

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            name, path, content = batch.columns
            # Contents are looked at where the batch holds them, one after another.
            reasons = [_gzip_fault(memoryview(c.as_buffer())) for c in content]
            yield pa.RecordBatch.from_arrays(
                [name, path, pa.array([r is None for r in reasons], pa.bool_()), pa.array(reasons, pa.string())],
                names=["name", "path", "ok", "reason"],
            )
        pa.default_memory_pool().release_unused()

    return files.select("name", "path", "content").mapInArrow(
        check, "name string, path string, ok boolean, reason string"
    )


def corrupt_files(checked: DataFrame) -> DataFrame:
    """Quarantine rows of the files that do not decompress."""
    return checked.where(~F.col("ok")).select(
        F.col("path").alias("source"),
        F.lit(None).cast("string").alias("doc_id"),
        F.lit("gunzip").alias("stage"),
        "reason",
    )
