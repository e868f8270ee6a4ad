"""Write the tables of one run so that they appear together or not at all.

Layout below the output folder: ``<table>/run_id=<id>/attempt=<id>/*.parquet`` and the log of ``sinks.runlog``. Readers
see only attempts that the log names, so a run that dies half-way, or is loaded twice at a time, leaves nothing behind.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession, functions as F

from citelake import schemas
from citelake.sinks.runlog import RunLog

WRITERS = 4
_RUN_ID = re.compile(r"[A-Za-z0-9][A-Za-z0-9._-]*")


def checked_run_id(run_id: str) -> str:
    """A run id becomes a folder name, so only letters, digits, dot, hyphen and underscore may be in it."""
    if not _RUN_ID.fullmatch(run_id):
        raise ValueError(f"not a run id: {run_id!r}")
    return run_id


def attempt_path(out: str, name: str, run_id: str, attempt: str) -> str:
    return f"{out}/{name}/run_id={run_id}/attempt={attempt}"


def write_tables(tables: Mapping[str, DataFrame], out: str, run_id: str) -> str:
    """Write every table of the run; returns the attempt, to be published.

    A few tables at a time, so that the last tasks of one leave no cores idle.
    """
    checked_run_id(run_id)
    attempt = uuid.uuid4().hex

    def write(table: tuple[str, DataFrame]) -> None:
        name, df = table
        df.write.parquet(attempt_path(out, name, run_id, attempt))

    with ThreadPoolExecutor(WRITERS) as writers:
        for _ in writers.map(write, tables.items()):
            pass
    return attempt


def publish(
    spark: SparkSession, out: str, run_id: str, attempt: str, totals: Mapping[str, int] | None = None
) -> bool:
    """Make the attempt visible, with what became of its inputs; False if another attempt of the run came first."""
    return RunLog(spark, out).finish(checked_run_id(run_id), attempt, totals)


def is_finished(spark: SparkSession, out: str, run_id: str) -> bool:
    return RunLog(spark, out).is_finished(checked_run_id(run_id))


def read_table(spark: SparkSession, out: str, name: str) -> DataFrame:
    """Rows of the finished runs."""
    schema = schemas.QUARANTINE if name == "quarantine" else schemas.TABLE_COLUMNS[name]
    rows = (
        spark.read.schema(f"{schema}, run_id string, attempt string")
        .option("basePath", f"{out}/{name}")
        .parquet(f"{out}/{name}")
    )
    runs = RunLog(spark, out).finished_runs().select("run_id", "attempt")
    return rows.join(runs, ["run_id", "attempt"], "left_semi").drop("run_id", "attempt")


def load_totals(spark: SparkSession, out: str) -> DataFrame:
    """``run_id, outcome, n``: how many inputs of every finished run were stored, left out or set aside, and why."""
    runs = RunLog(spark, out).finished_runs()
    return runs.select("run_id", F.explode("totals").alias("outcome", "n"))


def write_jdbc(
    tables: Mapping[str, DataFrame],
    url: str,
    properties: Mapping[str, str] | None = None,
    batch_size: int = 10_000,
    connections: int = 16,
    prefix: str = "",
) -> None:
    """Append the tables to a database in batches.

    Each task commits its own rows and a table is written after another, so
    load under a ``prefix`` for staging tables and let the database move them
    in one transaction of its own.
    """
    for name, df in tables.items():
        (
            df.write.format("jdbc")
            .mode("append")
            .options(**dict(properties or {}))
            .option("url", url)
            .option("dbtable", f"{prefix}{name}")
            .option("batchsize", batch_size)
            .option("numPartitions", connections)
            .save()
        )


def run_totals(outcomes: DataFrame, status: str = "status") -> DataFrame:
    """How many files or articles ended how."""
    return outcomes.groupBy(status).agg(F.count(F.lit(1)).alias("n"))
