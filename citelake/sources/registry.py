"""The organisation registry and its review sheet."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from citelake import schemas
from citelake.functions.text import jtrim, text_at


def read_registry(
    spark: SparkSession, path: str, whole: bool = False, layout: str = "array"
) -> DataFrame:
    """Registry entries with their place in the file (``pos``).

    The default reads what the dictionaries need; ``whole`` keeps every field
    of an entry, for writing a curated registry. ``layout="lines"`` reads what
    ``sinks.documents.write_registry`` wrote, places included.
    """
    if layout not in ("array", "lines"):
        raise ValueError(f"layout must be 'array' or 'lines', not {layout!r}")
    # An entry that does not parse ends the read: a broken registry is not an empty one.
    reader = spark.read.option("mode", "FAILFAST")
    if layout == "lines":
        return (reader if whole else reader.schema(f"{schemas.REGISTRY}, pos bigint")).json(path)
    reader = reader.option("multiLine", "true")
    if not whole:
        reader = reader.schema(schemas.REGISTRY)
    return reader.json(path).withColumn("pos", F.monotonically_increasing_id())


def read_review_sheet(spark: SparkSession, path: str) -> DataFrame:
    """``action, name`` from the sheet exported as CSV: columns 0 and 2, header skipped."""
    return (
        spark.read.schema("action string, no string, name string")
        .option("header", "true")
        .option("enforceSchema", "true")
        .option("escape", '"')
        .option("multiLine", "true")
        .csv(path)
        .select(
            jtrim(text_at(F.col("action"))).alias("action"),
            jtrim(text_at(F.col("name"))).alias("name"),
        )
    )
