"""Write recognised organisations and countries into the authors' affiliations."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from citelake.operators.keys import BUCKET, DIGITS, bucket_of, dealt_by_bucket
from citelake.operators.matching import NameIndex, best_per_article, build_index, hits_in_row

_IDS = ["doc_id", "source_file"]  # as keys.ARTICLE_ID
MODES = ("fallback", "independent")


def is_usable(affiliation: Column) -> Column:
    """Affiliations that are absent, empty or the text ``null`` are passed over."""
    return affiliation.isNotNull() & ~affiliation.isin("", "null")


def organisation_index(organisations: DataFrame, **limits: int) -> NameIndex:
    """From ``name, country_code, country_name``."""
    return build_index(organisations, "name", ["country_code", "country_name"], **limits)


def country_index(countries: DataFrame, **limits: int) -> NameIndex:
    """From ``country_name, country_code``."""
    return build_index(countries, "country_name", ["country_code"], **limits)


def affiliation_texts(authors: Column) -> Column:
    """The distinct usable affiliation texts of one article."""
    texts = F.flatten(
        F.transform(
            authors,
            lambda a: F.transform(
                F.coalesce(a["affiliations"], F.array()), lambda f: f["affiliation"]
            ),
        )
    )
    return F.array_distinct(F.filter(texts, is_usable))


def _with_lookup(
    rows: DataFrame, articles: DataFrame, index: NameIndex, name: str, how: str
) -> tuple[DataFrame, Callable[[Column], Column]]:
    """Rows able to look a text up, and the lookup itself."""
    if index.in_row:
        return rows, lambda text: F.get(hits_in_row(text, index), 0)
    texts = articles.select(*_IDS, affiliation_texts(F.col("authors")).alias("_texts"))
    ids, by = list(_IDS), None
    if BUCKET in rows.columns:
        # Both sides of the join are dealt by the bucket.
        texts, ids, by = texts.withColumn(BUCKET, bucket_of(_IDS, DIGITS)), [BUCKET, *_IDS], [BUCKET]
    found = best_per_article(texts, ids, "_texts", index, name, by)
    return rows.join(found, ids, how), lambda text: F.try_element_at(F.col(name), text)


def worked_out(rows: DataFrame, name: str, value: Column) -> DataFrame:
    """Add ``value`` as a column that is computed once per row.

    Later filters and lambdas would otherwise each take in the expression
    itself; the optimizer does not move it through a generator.
    """
    others = [c for c in rows.columns if c != name]
    return rows.select(*others, F.explode(F.array(value)).alias(name))


def enrich(
    articles: DataFrame,
    organisations: NameIndex,
    countries: NameIndex,
    mode: str = "fallback",
    require_both: bool | None = None,
    bucketed: bool = False,
) -> DataFrame:
    """Set ``institution_name``, ``country_code`` and ``country_name`` of each affiliation.

    ``fallback``: an organisation brings its own country; the country match
    counts only where no organisation was found. ``independent``: the country
    always comes from the country match. Without a hit earlier values stay.

    ``require_both`` keeps only articles in which some organisation and some
    country matched; by default in ``independent`` mode.

    ``bucketed``: deal the articles by number bucket before hits are joined to
    them and keep that column, so that numbering needs no shuffle of its own.
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}, not {mode!r}")
    if require_both is None:
        require_both = mode == "independent"

    # Where both must match, an article without hits need not pass the join.
    how = "inner" if require_both else "left"
    dealt = dealt_by_bucket(articles) if bucketed else articles
    rows, find_organisation = _with_lookup(dealt, articles, organisations, "_organisations", how)
    rows, find_country = _with_lookup(rows, articles, countries, "_countries", how)

    def marks_of(f: Column) -> Column:
        usable = is_usable(f["affiliation"])
        return F.struct(
            F.when(usable, find_organisation(f["affiliation"])).alias("org"),
            F.when(usable, find_country(f["affiliation"])).alias("ctry"),
        )

    marks = F.transform(
        "authors", lambda a: F.transform(F.coalesce(a["affiliations"], F.array()), marks_of)
    )
    rows = worked_out(rows, "_marks", marks)
    if require_both:
        found = F.flatten("_marks")
        rows = rows.where(
            F.exists(found, lambda m: m["org"].isNotNull())
            & F.exists(found, lambda m: m["ctry"].isNotNull())
        )

    def updated(f: Column, m: Column) -> Column:
        org, ctry = m["org"], m["ctry"]
        code = F.when(ctry.isNotNull(), ctry["country_code"]).otherwise(f["country_code"])
        name = F.when(ctry.isNotNull(), ctry["name"]).otherwise(f["country_name"])
        if mode == "fallback":
            code = F.when(org.isNotNull(), org["country_code"]).otherwise(code)
            name = F.when(org.isNotNull(), org["country_name"]).otherwise(name)
        return F.struct(
            f["affiliation"].alias("affiliation"),
            F.when(org.isNotNull(), org["name"])
            .otherwise(f["institution_name"])
            .alias("institution_name"),
            code.alias("country_code"),
            name.alias("country_name"),
        )

    def author(a: Column, i: Column) -> Column:
        of_author = F.get(F.col("_marks"), i)
        # Every author leaves with a list, be it empty.
        return a.withField(
            "affiliations",
            F.transform(
                F.coalesce(a["affiliations"], F.array()),
                lambda f, j: updated(f, F.get(of_author, j)),
            ),
        )

    return worked_out(rows, "authors", F.transform("authors", author)).select(*dealt.columns)
