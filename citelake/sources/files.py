"""Files as rows: listings, bytes and checksum sidecars."""

from __future__ import annotations

import fnmatch
import hashlib
import re
from collections.abc import Iterator

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from citelake.operators import integrity

CHECKS = "name string, path string, length bigint, md5 string, fault string, head binary"


def literal(path: str) -> str:
    """A path to read as it is, though it holds signs of a pattern."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", path)


def read_binary(spark: SparkSession, path: str | list[str], glob: str = "*.gz") -> DataFrame:
    """``name, path, length, content`` of every file below ``path``.

    Spark's file sources pass over files of no bytes, and a file may have 2 GB.
    """
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", glob)
        .load(path)
        .select(
            F.col("_metadata.file_name").alias("name"),
            F.col("_metadata.file_path").alias("path"),
            "length",
            "content",
        )
    )


class FilePartition(InputPartition):
    def __init__(self, path: str, length: int):
        self.path, self.length = path, length


class CheckReader(DataSourceReader):
    """One partition a file; a file is read in pieces of 1 MiB, whatever its size."""

    def __init__(self, options: dict):
        self.folder, self.glob = options["path"], options.get("glob", "*")
        self.head = int(options.get("head", 0))

    def _files(self) -> tuple[fs.FileSystem, str]:
        if "://" in self.folder or self.folder.startswith("file:"):
            return fs.FileSystem.from_uri(self.folder)
        return fs.LocalFileSystem(), self.folder

    def partitions(self) -> list[FilePartition]:
        system, folder = self._files()
        found = system.get_file_info(fs.FileSelector(folder, recursive=True))
        return [
            FilePartition(f.path, f.size) for f in found
            if f.is_file and not f.base_name.startswith((".", "_")) and fnmatch.fnmatchcase(f.base_name, self.glob)
        ] or [FilePartition("", 0)]

    def read(self, partition: FilePartition) -> Iterator[tuple]:
        if not partition.path:
            return
        name = partition.path.rsplit("/", 1)[-1]
        digest, length, head = hashlib.md5(), 0, b""
        system, _ = self._files()
        with system.open_input_stream(partition.path, compression=None, buffer_size=0) as stream:
            def pieces() -> Iterator[bytes]:
                nonlocal length, head
                while piece := stream.read(integrity.STEP):
                    digest.update(piece)
                    length += len(piece)
                    if len(head) < self.head:
                        head += piece[: self.head - len(head)]
                    yield piece

            each = pieces()
            fault = integrity.gzip_fault(each) if name.endswith(".gz") else None
            for _ in each:  # what a damaged file still holds counts for the hash
                pass
        yield name, partition.path, length, digest.hexdigest(), fault, head


class FileChecks(DataSource):
    """Files hashed and, if their names end with ``.gz``, inflated: ``name, path, length, md5, fault, head``.

    Files of zero bytes and of any size are read. ``path`` is a folder that the
    driver and all executors can open as pyarrow does (local, ``hdfs://``, ``s3://``, …).
    Options: ``glob`` of names; ``head``, how many bytes to keep of each file's beginning.
    """

    @classmethod
    def name(cls) -> str:
        return "file_checks"

    def schema(self) -> str:
        return CHECKS

    def reader(self, schema) -> CheckReader:
        return CheckReader(self.options)


def read_checks(spark: SparkSession, path: str, glob: str = "*", head: int = 0) -> DataFrame:
    spark.dataSource.register(FileChecks)
    return spark.read.format(FileChecks.name()).option("glob", glob).option("head", head).load(path)


def checked_sidecars(spark: SparkSession, path: str) -> DataFrame:
    """As ``read_sidecars``, with the paths of ``read_checks``. A sidecar is some dozens of bytes; 4096 are looked at."""
    found = read_checks(spark, path, "*.md5", 4096)
    return found.select(
        F.regexp_replace("name", r"\.md5$", "").alias("name"), F.regexp_replace("path", r"\.md5$", "").alias("path"),
        F.decode("head", "utf-8").alias("checksum"),
    )


def read_sidecars(spark: SparkSession, path: str) -> DataFrame:
    """``name, path, checksum``: the text of every ``*.md5`` file and the file it speaks of."""
    return (
        spark.read.option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.md5")
        .text(path, wholetext=True)
        .select(
            F.regexp_replace("_metadata.file_name", r"\.md5$", "").alias("name"),
            F.regexp_replace("_metadata.file_path", r"\.md5$", "").alias("path"),
            F.col("value").alias("checksum"),
        )
    )


def new_files(remote: DataFrame, held: DataFrame) -> DataFrame:
    """The ``.gz`` names of a listing that are not held yet.

    ``held`` should list verified files only (``integrity.verified``): a
    partial transfer must be fetched again.
    """
    return remote.where(F.col("name").endswith(".gz")).join(
        held.select("name"), "name", "left_anti"
    )
