"""Which articles are stored."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from citelake.functions.text import nonblank, to_int


def _affiliations(authors: Column) -> Column:
    return F.flatten(F.transform(authors, lambda a: F.coalesce(a["affiliations"], F.array())))


def _some(affiliations: Column, test) -> Column:
    return F.coalesce(F.exists(affiliations, test), F.lit(False))


def has_recognised(authors: Column, need_text: bool = False) -> Column:
    """Some affiliation has a country code and some, maybe another, an institution.

    ``need_text``: count only affiliations that carry an affiliation text node.
    """
    affiliations = _affiliations(authors)
    if need_text:
        affiliations = F.filter(affiliations, lambda f: f["affiliation"].isNotNull())
    return _some(affiliations, lambda f: nonblank(f["country_code"])) & _some(
        affiliations, lambda f: nonblank(f["institution_name"])
    )


def is_pubmed_date(d: Column) -> Column:
    return F.coalesce(d["pub_status"] == "pubmed", F.lit(False))


def has_year(pub_dates: Column, min_year: int) -> Column:
    return _some(pub_dates, lambda d: is_pubmed_date(d) & (to_int(d["year"]) >= min_year))


def gate_any(articles: DataFrame) -> DataFrame:
    return articles.where(has_recognised(F.col("authors")))


def gate_with_affiliation(articles: DataFrame) -> DataFrame:
    return articles.where(has_recognised(F.col("authors"), need_text=True))


def gate_year(articles: DataFrame, min_year: int = 2014) -> DataFrame:
    """Keep articles with a date of status ``pubmed`` in ``min_year`` or later."""
    return articles.where(has_year(F.col("pub_dates"), min_year))
