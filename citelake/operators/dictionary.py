"""Name dictionaries from the organisation registry."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from citelake.functions.text import equal_ignoring_case, jtrim, text_at


def last_wins(entries: DataFrame, key: str, pos: str, values: list[str]) -> DataFrame:
    """One row per non-empty ``key``: the entry with the highest ``pos``.

    Pre-aggregated before the shuffle, so a name that repeats very often costs
    one row per task.
    """
    best = F.max(F.struct(F.col(pos).alias("_pos"), *[F.col(v) for v in values]))
    return (
        entries.where(F.col(key) != "")
        .groupBy(key)
        .agg(best.alias("_best"))
        .select(key, *[F.col(f"_best.{v}").alias(v) for v in values])
    )


def _text(path: str, name: str) -> Column:
    return text_at(F.col(path)).alias(name)


def organisation_dictionary(registry: DataFrame) -> DataFrame:
    """``name, country_code, country_name``."""
    entries = registry.select(
        _text("name", "name"),
        _text("country.country_code", "country_code"),
        _text("country.country_name", "country_name"),
        "pos",
    )
    return last_wins(entries, "name", "pos", ["country_code", "country_name"])


def country_dictionary(registry: DataFrame) -> DataFrame:
    """``country_name, country_code``."""
    entries = registry.select(
        _text("country.country_name", "country_name"),
        _text("country.country_code", "country_code"),
        "pos",
    )
    return last_wins(entries, "country_name", "pos", ["country_code"])


def curate(registry: DataFrame, sheet: DataFrame) -> DataFrame:
    """Registry entries left after the sheet's ``Delete`` rows, names compared
    trimmed and ignoring case. All entry fields are kept.
    """
    deleted = (
        sheet.where(equal_ignoring_case(F.col("action"), F.lit("delete")) & (F.col("name") != ""))
        .select(F.lower(jtrim(F.col("name"))).alias("_deleted"))
        .distinct()
    )
    return registry.join(
        deleted, F.lower(jtrim(F.col("name"))) == F.col("_deleted"), "left_anti"
    )
