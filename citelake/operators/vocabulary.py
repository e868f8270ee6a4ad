"""Subject-heading vocabulary tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from citelake.functions.text import text_at


def mesh_desc_list(descriptors: DataFrame) -> DataFrame:
    return descriptors.select(
        text_at(F.col("descriptor_ui")).alias("descriptor_ui"),
        text_at(F.col("descriptor_name")).alias("descriptor_name"),
    )


def mesh_trees(descriptors: DataFrame) -> DataFrame:
    """One row per tree number; the category is its first letter."""
    return descriptors.select(
        text_at(F.col("descriptor_ui")).alias("descriptor_ui"),
        F.explode("tree_numbers").alias("mesh_tree"),
    ).withColumn("mesh_category", F.substring("mesh_tree", 1, 1))


def flatten_descriptors(descriptors: DataFrame) -> dict[str, DataFrame]:
    return {
        "pub_mesh_desc_list": mesh_desc_list(descriptors),
        "pub_mesh_trees": mesh_trees(descriptors),
    }
