"""Scalar rules on text, as column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

# Tags that may stand inside a text and carry only its looks. The last is a pattern: formulas in
# MathML have all their elements under this prefix.
INLINE_TAGS = ("i", "b", "u", "sub", "sup", r"mml:\w+")

_NUMBER = r"^[\x00-\x20]*[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?[\x00-\x20]*$"


def text_at(c: Column) -> Column:
    """The text at a path, or the empty string where the path is missing."""
    return F.coalesce(c, F.lit(""))


def jtrim(c: Column) -> Column:
    """Trim every character up to U+0020, not only spaces."""
    return F.regexp_replace(c, r"^[\x00-\x20]+|[\x00-\x20]+$", "")


def nonblank(c: Column) -> Column:
    """True when something other than blanks is there; false for NULL."""
    return F.coalesce(c.rlike(r"[^\x00-\x20]"), F.lit(False))


def to_int(c: Column) -> Column:
    """Text to int: 0 when missing, out of range or not a number."""
    number = F.when(c.rlike(_NUMBER), jtrim(c)).try_cast("double").try_cast("int")
    return F.coalesce(number, F.lit(0))


def equal_ignoring_case(a: Column, b: Column) -> Column:
    return F.lower(a) == F.lower(b)


def inline_tag_pattern(tags: Sequence[str] = INLINE_TAGS) -> str:
    return r"</?(?:" + "|".join(tags) + r")(?:\s[^<>]*)?/?>"


def strip_tags(c: Column, tags: Sequence[str] = INLINE_TAGS) -> Column:
    """Drop the listed tags and keep their text.

    On raw XML this is exact: a genuine ``<`` is still written ``&lt;`` there.
    """
    return F.regexp_replace(c, inline_tag_pattern(tags), "")
