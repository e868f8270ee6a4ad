"""Unfold numbered articles into the relational tables.

Each function is one projection over the article row; those with surrogate
numbers need the bases of ``keys.number_articles``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from citelake.functions.text import text_at, to_int
from citelake.operators.gates import is_pubmed_date


def _pmid() -> Column:
    return to_int(F.col("pmid")).alias("pmid")


def _text(path: str, name: str) -> Column:
    return text_at(F.col(path)).alias(name)


def _null(name: str) -> Column:
    return F.lit(None).cast("string").alias(name)


def pmid_list(articles: DataFrame) -> DataFrame:
    return articles.select(_pmid())


def pubdate(articles: DataFrame, min_year: int | None = None) -> DataFrame:
    """The first date of status ``pubmed``; with ``min_year`` every such date from that year on."""
    if min_year is None:
        first = F.get(F.filter("pub_dates", is_pubmed_date), 0)
        rows = articles.select("pmid", first.alias("d")).where(F.col("d").isNotNull())
    else:
        wanted = F.filter(
            "pub_dates", lambda d: is_pubmed_date(d) & (to_int(d["year"]) >= min_year)
        )
        rows = articles.select("pmid", F.explode(wanted).alias("d"))
    return rows.select(
        _pmid(),
        to_int(F.col("d.year")).alias("year"),
        to_int(F.col("d.month")).alias("month"),
        to_int(F.col("d.day")).alias("day"),
    )


def article_title(articles: DataFrame) -> DataFrame:
    return articles.select(_pmid(), _text("title", "article_title"))


def author(articles: DataFrame) -> DataFrame:
    rows = articles.select("pmid", "author_base", F.posexplode("authors").alias("pos", "a"))
    return rows.select(
        _pmid(),
        (F.col("author_base") + F.col("pos")).alias("author_no"),
        _text("a.valid_yn", "valid_yn"),
        _text("a.last_name", "lastname"),
        _text("a.fore_name", "forename"),
        _null("collectivename"),
        _text("a.initials", "initials"),
        _text("a.suffix", "suffix"),
        _text("a.identifier_source", "identifier_source"),
        _text("a.identifier", "identifier"),
    )


def _affiliation_rows(articles: DataFrame) -> DataFrame:
    def of_author(a: Column, i: Column) -> Column:
        return F.transform(
            F.filter(
                F.coalesce(a["affiliations"], F.array()), lambda f: f["affiliation"].isNotNull()
            ),
            lambda f: F.struct(
                i.alias("author_pos"),
                a["identifier_source"].alias("identifier_source"),
                a["identifier"].alias("identifier"),
                f.alias("f"),
            ),
        )

    rows = F.flatten(F.transform("authors", of_author))
    return articles.select(
        "pmid", "author_base", "affiliation_base", F.posexplode(rows).alias("pos", "r")
    ).select(
        "pmid",
        (F.col("author_base") + F.col("r.author_pos")).alias("author_no"),
        (F.col("affiliation_base") + F.col("pos")).alias("affiliation_no"),
        "r",
    )


def affiliation(articles: DataFrame) -> DataFrame:
    """One row per affiliation; its identifier is the author's."""
    return _affiliation_rows(articles).select(
        _pmid(),
        "affiliation_no",
        _text("r.f.affiliation", "affiliation"),
        _text("r.f.country_code", "affiliation_country"),
        _text("r.f.institution_name", "affiliation_organization"),
        _text("r.identifier_source", "affiliation_identifier_source"),
        _text("r.identifier", "affiliation_identifier"),
    )


def author_affiliation(articles: DataFrame) -> DataFrame:
    return _affiliation_rows(articles).select(_pmid(), "author_no", "affiliation_no")


def journal(articles: DataFrame) -> DataFrame:
    return articles.select(
        _pmid(),
        _text("journal.title", "title"),
        _text("journal.iso_abbreviation", "iso_abbreviation"),
        _text("journal.volume", "volume"),
        _text("journal.issue", "issue"),
        to_int(F.col("journal.pub_year")).alias("pub_year"),
        _text("journal.pub_month", "pub_month"),
        to_int(F.col("journal.pub_day")).alias("pub_day"),
    )


def mesh_heading(articles: DataFrame) -> DataFrame:
    """One row per (heading, qualifier); a heading without qualifiers keeps one row."""
    headings = articles.select(
        "pmid", "heading_base", F.posexplode("headings").alias("pos", "h")
    )
    rows = headings.select(
        "pmid", "heading_base", "pos", "h", F.explode_outer("h.qualifiers").alias("q")
    )

    def of_qualifier(field: str, name: str) -> Column:
        return F.when(F.col("q").isNotNull(), text_at(F.col(f"q.{field}"))).alias(name)

    return rows.select(
        _pmid(),
        (F.col("heading_base") + F.col("pos")).alias("descriptor_index"),
        _text("h.descriptor_name", "descriptor_name"),
        _text("h.descriptor_major_topic_yn", "descriptor_major_topic_yn"),
        _null("descriptor_type"),
        _text("h.descriptor_ui", "descriptor_ui"),
        of_qualifier("name", "qualifier_name"),
        of_qualifier("major_topic_yn", "qualifer_major_topic_yn"),
        of_qualifier("ui", "qualifier_ui"),
    )


# Reference id types that have a column.
REFERENCE_ID_TYPES = ("pubmed", "doi", "pmcid", "pii")


def reference(articles: DataFrame) -> DataFrame:
    """One row per reference, its ids by lower-cased type; the last of a type counts."""
    rows = articles.select("pmid", "reference_base", F.posexplode("references").alias("pos", "r"))

    def id_of(kind: str) -> Column:
        of_kind = F.filter("r.article_ids", lambda i: F.lower(i["id_type"]) == kind)
        values = F.transform(of_kind, lambda i: text_at(i["value"]))
        return F.try_element_at(values, F.lit(-1)).alias(f"ref_article_id_{kind}")

    return rows.select(
        _pmid(),
        (F.col("reference_base") + F.col("pos")).alias("ref_no"),
        _text("r.citation", "citation"),
        *[id_of(kind) for kind in REFERENCE_ID_TYPES],
    )


def databank_list(articles: DataFrame) -> DataFrame:
    """One row per (databank, accession number)."""
    banks = articles.select(
        "pmid", "databanks.complete_yn", F.explode("databanks.banks").alias("b")
    )
    return banks.select(
        _pmid(),
        _text("complete_yn", "databank_list_complete_yn"),
        _text("b.name", "databank_name"),
        F.explode("b.accession_numbers").alias("accession_number"),
    ).withColumn("accession_number", text_at(F.col("accession_number")))


def keyword_list(articles: DataFrame) -> DataFrame:
    rows = articles.select("pmid", "keyword_base", F.posexplode("keywords").alias("pos", "k"))
    return rows.select(
        (F.col("keyword_base") + F.col("pos")).alias("keyword_index"),
        _pmid(),
        _text("k.keyword", "keyword"),
        _text("k.major_topic_yn", "keyword_major_topic_yn"),
    )


def flatten_articles(numbered: DataFrame, min_year: int | None = None) -> dict[str, DataFrame]:
    """All article tables by name."""
    return {
        "pub_pmid_list": pmid_list(numbered),
        "pub_pubdate": pubdate(numbered, min_year),
        "pub_article_title": article_title(numbered),
        "pub_author": author(numbered),
        "pub_affiliation": affiliation(numbered),
        "pub_author_affiliation": author_affiliation(numbered),
        "pub_journal": journal(numbered),
        "pub_mesh_heading": mesh_heading(numbered),
        "pub_reference": reference(numbered),
        "pub_databank_list": databank_list(numbered),
        "pub_keyword_list": keyword_list(numbered),
    }
