"""Read subject-heading vocabulary records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from citelake import schemas
from citelake.sources.articles import read_records, with_doc_ids

RECORD_TAG = "DescriptorRecord"


def parse_descriptors(records: DataFrame) -> DataFrame:
    """``descriptor_ui, descriptor_name, tree_numbers`` of each record.

    The schema names direct children only, so the record's own UI and name
    count, not those of concepts and references inside it.
    """
    kept = [c for c in records.columns if c != "record"]
    parsed = F.from_xml(
        F.col("record"),
        schemas.RAW_DESCRIPTOR,
        {
            "mode": "PERMISSIVE",
            "columnNameOfCorruptRecord": schemas.CORRUPT,
            "ignoreSurroundingSpaces": "false",
        },
    )
    return records.select(*kept, parsed.alias("x")).select(
        *kept,
        F.col("x.DescriptorUI").alias("descriptor_ui"),
        F.col("x.DescriptorName.String").alias("descriptor_name"),
        F.coalesce(F.col("x.TreeNumberList.TreeNumber"), F.array()).alias("tree_numbers"),
        F.col(f"x.{schemas.CORRUPT}"),
    )


def read_descriptors(
    spark: SparkSession, path: str, glob: str = "*.{xml,xml.gz}"
) -> DataFrame:
    """Vocabulary records of every XML file below ``path``, with ``_malformed``."""
    return parse_descriptors(with_doc_ids(read_records(spark, path, tag=RECORD_TAG, glob=glob)))
