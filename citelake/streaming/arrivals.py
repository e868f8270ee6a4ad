"""Take in newly arrived citation files, each once."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from citelake.plans.load import ingest_records, named_records

#: The columns of Spark's source of whole files, fixed by it.
BINARY_FILE = "path string, modificationTime timestamp, length bigint, content binary"


def start_arrivals(
    spark: SparkSession,
    path: str,
    checkpoint: str,
    handle: Callable[[DataFrame, DataFrame, str], object],
    name: str = "arrivals",
    max_files: int = 1000,
    glob: str = "*.{xml,xml.gz}",
) -> StreamingQuery:
    """Run ``handle(articles, quarantine, run_id)`` over the files not seen before.

    Stops when all present files are done. The stream itself only lists: a
    micro-batch is the names of up to ``max_files`` files, read as a batch load
    reads them, so a damaged gzip file becomes a quarantine row and the others
    go on. A whole file is always in one micro-batch. After a failure the same
    micro-batch comes again under the same ``run_id``, so a handler that writes
    by run (``plans.load.store``) takes every file exactly once.
    """
    arrivals = (
        spark.readStream.format("binaryFile")
        .schema(BINARY_FILE)
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", glob)
        .option("maxFilesPerTrigger", max_files)
        .load(path)
        .select("path")
    )

    def on_batch(batch: DataFrame, epoch: int) -> None:
        names = sorted(row.path for row in batch.collect())
        if not names:
            return
        zipped = [n for n in names if n.endswith(".gz")]
        records, damaged = named_records(spark, [n for n in names if not n.endswith(".gz")], zipped)
        articles, malformed = ingest_records(records)
        handle(articles, malformed.unionByName(damaged), f"{name}-{epoch:09d}")

    return (
        arrivals.writeStream.foreachBatch(on_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
