"""Articles as JSON documents."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from citelake.functions import trees

PER_FILE = 100_000
#: Documents repeat their keys in every line: plain they take some ten times the disk. Files are small, so one is one task's work.
COMPRESSED = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED"}


def write_documents(documents: DataFrame, path: str, per_file: int = PER_FILE) -> None:
    """``doc_id, json`` as lines ``{"doc_id": …, "article": {…}}``; a column ``article`` that holds the same tree is written as it is."""
    (
        documents.select("doc_id", _article(documents))
        .write.options(maxRecordsPerFile=per_file, **COMPRESSED)
        .json(path)
    )


def _article(documents: DataFrame) -> Column:
    # A tree at hand need not go through text and a parser first.
    return F.col("article") if "article" in documents.columns else F.try_parse_json("json").alias("article")


def write_batches(documents: DataFrame, path: str) -> None:
    """As ``write_documents``, in a folder per value of ``batch``.

    A batch has a bounded number of documents, so it may be one task's work.
    """
    (
        documents.select("batch", "doc_id", _article(documents))
        .repartition("batch")
        .write.options(**COMPRESSED)
        .partitionBy("batch")
        .json(path)
    )


def enriched_json(articles: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    """``doc_id, json, article`` and ``extra`` columns: each article's own ``tree`` with what enrichment found, as text and as a variant.

    The three names of an affiliation are set, where they were found, and in a
    list of authors each leaves with an ``AffiliationInfo``, be it empty;
    everything else of the document stays as it was.
    """

    def affiliation(info: Column, found: Column) -> Column:
        names = ("institution_name", "country_code", "country_name")
        return trees.with_texts(info, {name: found[name] for name in names})

    def author(tree: Column, place: Column) -> Column:
        found = F.get(F.col("authors"), place)["affiliations"]
        return trees.changed(
            tree,
            "AffiliationInfo",
            lambda group: trees.changed_members(group, lambda info, i: affiliation(info, F.get(found, i))),
        )

    def authors(group: Column) -> Column:
        return trees.changed_members(group, author, lambda a: trees.with_member(a, "AffiliationInfo"))

    new = trees.changed(
        F.col("tree"),
        "MedlineCitation",
        lambda m: trees.changed(
            m,
            "Article",
            lambda a: trees.changed(
                a,
                "AuthorList",
                lambda l: trees.changed(l, "Author", authors),
            ),
        ),
    )
    return articles.select("doc_id", F.to_json(new).alias("json"), new.alias("article"), *extra)


def _value(c: Column, name: str) -> Column:
    return F.when(c.isNotNull(), F.struct(c.alias("value"))).alias(name)


def article_json(articles: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    """``doc_id, json, article`` and ``extra`` columns: article rows in the nested shape of the citation XML, as text and as a struct.

    Absent keys are left out; groups are always arrays.
    """

    def affiliation(f: Column) -> Column:
        return F.struct(
            _value(f["affiliation"], "Affiliation"),
            f["institution_name"].alias("institution_name"),
            f["country_code"].alias("country_code"),
            f["country_name"].alias("country_name"),
        )

    def author(a: Column) -> Column:
        identified = a["identifier"].isNotNull() | a["identifier_source"].isNotNull()
        return F.struct(
            a["valid_yn"].alias("ValidYN"),
            _value(a["last_name"], "LastName"),
            _value(a["fore_name"], "ForeName"),
            _value(a["initials"], "Initials"),
            _value(a["suffix"], "Suffix"),
            F.when(
                identified,
                F.struct(
                    a["identifier_source"].alias("Source"), a["identifier"].alias("value")
                ),
            ).alias("Identifier"),
            F.transform(a["affiliations"], affiliation).alias("AffiliationInfo"),
        )

    def heading(h: Column) -> Column:
        return F.struct(
            F.struct(
                h["descriptor_name"].alias("value"),
                h["descriptor_major_topic_yn"].alias("MajorTopicYN"),
                h["descriptor_ui"].alias("UI"),
            ).alias("DescriptorName"),
            F.transform(
                h["qualifiers"],
                lambda q: F.struct(
                    q["name"].alias("value"),
                    q["major_topic_yn"].alias("MajorTopicYN"),
                    q["ui"].alias("UI"),
                ),
            ).alias("QualifierName"),
        )

    def reference(r: Column) -> Column:
        return F.struct(
            _value(r["citation"], "Citation"),
            F.struct(
                F.transform(
                    r["article_ids"],
                    lambda i: F.struct(i["id_type"].alias("IdType"), i["value"].alias("value")),
                ).alias("ArticleId")
            ).alias("ArticleIdList"),
        )

    def bank(b: Column) -> Column:
        return F.struct(
            _value(b["name"], "DataBankName"),
            F.struct(
                F.transform(b["accession_numbers"], lambda n: F.struct(n.alias("value"))).alias(
                    "AccessionNumber"
                )
            ).alias("AccessionNumberList"),
        )

    def date(d: Column) -> Column:
        return F.struct(
            d["pub_status"].alias("PubStatus"),
            _value(d["year"], "Year"),
            _value(d["month"], "Month"),
            _value(d["day"], "Day"),
        )

    def keyword(k: Column) -> Column:
        return F.struct(k["keyword"].alias("value"), k["major_topic_yn"].alias("MajorTopicYN"))

    journal, banks = F.col("journal"), F.col("databanks")
    article = F.struct(
        F.struct(
            _value(journal["title"], "Title"),
            _value(journal["iso_abbreviation"], "ISOAbbreviation"),
            F.struct(
                _value(journal["volume"], "Volume"),
                _value(journal["issue"], "Issue"),
                F.struct(
                    _value(journal["pub_year"], "Year"),
                    _value(journal["pub_month"], "Month"),
                    _value(journal["pub_day"], "Day"),
                ).alias("PubDate"),
            ).alias("JournalIssue"),
        ).alias("Journal"),
        _value(F.col("title"), "ArticleTitle"),
        F.struct(F.transform("authors", author).alias("Author")).alias("AuthorList"),
        F.struct(
            banks["complete_yn"].alias("CompleteYN"),
            F.transform(banks["banks"], bank).alias("DataBank"),
        ).alias("DataBankList"),
    )
    tree = F.struct(
        F.struct(
            _value(F.col("pmid"), "PMID"),
            article.alias("Article"),
            F.struct(F.transform("headings", heading).alias("MeshHeading")).alias(
                "MeshHeadingList"
            ),
            F.struct(F.transform("keywords", keyword).alias("Keyword")).alias("KeywordList"),
        ).alias("MedlineCitation"),
        F.struct(
            F.struct(F.transform("pub_dates", date).alias("PubMedPubDate")).alias("History"),
            F.struct(F.transform("references", reference).alias("Reference")).alias(
                "ReferenceList"
            ),
        ).alias("PubmedData"),
    )
    return articles.select(*extra, "doc_id", F.to_json(tree).alias("json"), tree.alias("article"))


def write_registry(registry: DataFrame, path: str) -> None:
    """A curated registry, one entry per line with its place in the original."""
    registry.write.json(path)
