"""Read citations from XML or JSON files into article rows."""

from __future__ import annotations

import codecs
import itertools
import json
from collections.abc import Callable, Iterator, Sequence
from xml.etree import ElementTree

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from citelake import schemas
from citelake.functions.text import INLINE_TAGS, strip_tags
from citelake.functions.trees import leaf, node, one_or_many, shape, shaped_members
from citelake.operators import integrity
from citelake.session import stage

RECORD_TAG = "PubmedArticle"
#: Splits of files up to which their table is sent to the tasks.
BROADCAST_SPLITS = 1_000_000
#: Bytes of a row group of inflated records: one gzip file is written by one task and parsed by many.
INFLATED_GROUP = 8 << 20


# ---------------------------------------------------------------- XML records

def read_records(
    spark: SparkSession,
    path: str | list[str],
    tag: str = RECORD_TAG,
    glob: str = "*.{xml,xml.gz}",
) -> DataFrame:
    """One row per ``tag`` element below ``path``: its XML text and where it stood.

    The text reader cuts files at the closing tag, so a large uncompressed file
    is read by many tasks; gzip files are opened directly. Other elements of
    the file are ignored. What lies between two closing tags is cut again at
    every opening one, so a lost closing tag costs its own record only: that comes without
    the tag and is malformed. A damaged gzip ends the job (see ``gzip_records``).
    """
    # Mostly one opening tag lies before a closing one: that takes no pattern. The outer explode gets no inferred
    # filter, which would cut every text again.
    value, opening = F.col("value"), f"<{tag}"
    at, whole = F.locate(opening, value), F.concat(value, F.lit(f"</{tag}>"))
    single = (
        (at > 0) & _opens(F.substr(value, at), tag) & ~F.contains(F.substr(value, at + 1), F.lit(opening))
        & F.is_valid_utf8(value)
    )
    pieces = F.when(single, F.array(F.substr(whole, at))).otherwise(F.split(whole, rf"(?=<{tag}[\s>])"))
    lines = (
        spark.read.option("lineSep", f"</{tag}>")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", glob)
        .format("text")
        .schema("value string")
        .load(path)
        .select(
            F.explode_outer(pieces).alias("record"),
            F.col("_metadata.file_path").alias("source_file"),
            F.col("_metadata.file_name").alias("file_name"),
            F.col("_metadata.file_block_start").alias("block"),
        )
        .where(_opens(F.col("record"), tag))
    )
    return with_sequence(lines)


def _opens(text: Column, tag: str) -> Column:
    """True when ``text`` begins with the opening tag."""
    return text.startswith(f"<{tag}") & F.substring(text, len(tag) + 2, 1).isin(">", *" \t\n\x0b\f\r")


def _cut(texts: Iterator[str], tag: str) -> Iterator[str]:
    """Records of a file that comes in pieces, cut as ``read_records`` cuts them. Holds one record and one piece."""
    closing, opening = f"</{tag}>", f"<{tag}"
    rest = ""

    def places(between: str) -> Iterator[int]:
        at = between.find(opening)
        while at >= 0:
            after = between[at + len(opening) : at + len(opening) + 1]
            if after == ">" or after.isspace():
                yield at
            at = between.find(opening, at + 1)

    def records(between: str) -> Iterator[str]:
        starts = list(places(between))
        for start, end in zip(starts, [*starts[1:], None]):
            yield between[start:end] + (closing if end is None else "")

    for text in texts:
        *whole, rest = (rest + text).split(closing)
        for between in whole:
            yield from records(between)
    yield from records(rest)


def gzip_records(files: DataFrame, tag: str = RECORD_TAG) -> tuple[DataFrame, DataFrame]:
    """(records as from ``read_records``, quarantine rows) of gzip files given as ``name, path, content``.

    Every file is inflated once, in pieces. Whether it is whole is known at its
    end only: the records are staged, those of damaged files left out.
    """
    schema = "source_file string, file_name string, block bigint, seq bigint, record string, fault string"

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, path, content in zip(*batch.columns):
                yield from _file_records(name.as_py(), path.as_py(), content.as_py() or b"", tag)

    found = stage(files.select("name", "path", "content").mapInArrow(read, schema), "inflated", INFLATED_GROUP)
    damaged = found.where("fault IS NOT NULL")
    records = found.where("record IS NOT NULL").drop("fault")
    if damaged.isEmpty():
        return records, integrity.corrupt_files(damaged.select(F.lit(None).cast("string").alias("path"), F.lit(True).alias("ok"), F.col("fault").alias("reason")))
    names = damaged.select(F.col("source_file").alias("path"), F.lit(False).alias("ok"), F.col("fault").alias("reason"))
    return records.join(damaged.select("source_file"), "source_file", "left_anti"), integrity.corrupt_files(names)


def _file_records(name: str, path: str, content: bytes, tag: str) -> Iterator[pa.RecordBatch]:
    fault: list[str] = []

    def texts() -> Iterator[str]:
        decoder = codecs.getincrementaldecoder("utf-8")("replace")
        for piece in integrity.inflated(integrity.sliced(content)):
            if isinstance(piece, str):
                fault.append(piece)
                return
            yield decoder.decode(piece)
        yield decoder.decode(b"", final=True)

    seq = 0
    for held in itertools.batched(_cut(texts(), tag), 256):
        yield _record_rows(name, path, range(seq, seq + len(held)), held, [None] * len(held))
        seq += len(held)
    if fault:
        yield _record_rows(name, path, [seq], [None], fault)


def _record_rows(name: str, path: str, seq, records, faults) -> pa.RecordBatch:
    n = len(records)
    return pa.RecordBatch.from_arrays(
        [
            pa.array([path] * n, pa.string()), pa.array([name] * n, pa.string()), pa.array([0] * n, pa.int64()),
            pa.array(list(seq), pa.int64()), pa.array(list(records), pa.string()), pa.array(list(faults), pa.string()),
        ],
        names=["source_file", "file_name", "block", "seq", "record", "fault"],
    )


def with_sequence(records: DataFrame) -> DataFrame:
    """Add the row number inside a scan task."""
    return records.withColumn("seq", F.monotonically_increasing_id())


def file_base(name: Column) -> Column:
    """File name without ``.gz`` and ``.xml``."""
    base = F.when(name.contains(".gz"), F.regexp_replace(name, r"\.gz$", "")).otherwise(name)
    return F.replace(base, F.lit(".xml"), F.lit(""))


def with_doc_ids(records: DataFrame) -> DataFrame:
    """Add ``doc_id`` = file base, ``_``, 0-based position in the file.

    Rows of one split are consecutive, so a position is the row's offset in its
    split plus the rows of the file's earlier splits. Only the table of splits
    is grouped by file, never the records. The table goes to the records while
    it has at most ``BROADCAST_SPLITS`` rows, some 100 bytes each; beyond that the records are shuffled.

    ``records`` is evaluated twice: stage it if it is costly.
    """
    splits = records.groupBy("source_file", "block").agg(
        F.count(F.lit(1)).alias("n"), F.min("seq").alias("first_seq")
    )
    earlier = Window.partitionBy("source_file").orderBy("block").rowsBetween(
        Window.unboundedPreceding, -1
    )
    splits = splits.select(
        "source_file",
        "block",
        (F.coalesce(F.sum("n").over(earlier), F.lit(0)) - F.col("first_seq")).alias("shift"),
    )
    splits = stage(splits, "splits")
    if splits.limit(BROADCAST_SPLITS + 1).count() <= BROADCAST_SPLITS:
        splits = F.broadcast(splits)
    position = F.col("seq") + F.col("shift")
    return (
        records.join(splits, ["source_file", "block"])
        .withColumn(
            "doc_id", F.concat_ws("_", file_base(F.col("file_name")), position.cast("string"))
        )
        .drop("shift", "block", "seq", "file_name")
    )


def parse_records(records: DataFrame, inline_tags: Sequence[str] = INLINE_TAGS) -> DataFrame:
    """XML text to article columns; other columns are kept.

    A record that is not well-formed has its text in ``_malformed`` and NULL in
    every article column; see ``split_malformed``.
    """
    # Whole text of titles and the like: inline tags go before parsing, while a
    # genuine `<` is still escaped.
    xml = strip_tags(F.col("record"), inline_tags) if inline_tags else F.col("record")
    parsed = F.from_xml(
        xml,
        schemas.RAW_ARTICLE,
        {
            "mode": "PERMISSIVE",
            "columnNameOfCorruptRecord": schemas.CORRUPT,
            "ignoreSurroundingSpaces": "false",
        },
    )
    kept = [c for c in records.columns if c != "record"]
    rows = records.select(*kept, parsed.alias("x"))
    return rows.select(*kept, *_columns_from_xml(F.col("x")), F.col(f"x.{schemas.CORRUPT}"))


def split_malformed(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(readable articles, quarantine rows)."""
    good = parsed.where(F.col(schemas.CORRUPT).isNull()).drop(schemas.CORRUPT)
    bad = parsed.where(F.col(schemas.CORRUPT).isNotNull()).select(
        F.col("source_file").alias("source"),
        "doc_id",
        F.lit("parse").alias("stage"),
        F.lit("malformed").alias("reason"),
    )
    return good, bad


def read_articles(
    spark: SparkSession,
    path: str,
    inline_tags: Sequence[str] = INLINE_TAGS,
    glob: str = "*.{xml,xml.gz}",
) -> DataFrame:
    """Article rows of every XML file below ``path``, with ``_malformed``."""
    records = with_doc_ids(read_records(spark, path, glob=glob))
    return order_columns(parse_records(records, inline_tags))


def read_articles_by_row_tag(
    spark: SparkSession, path: str, inline_tags: Sequence[str] = INLINE_TAGS
) -> DataFrame:
    """As ``read_articles`` through the XML source, for XML that is not laid out
    as plain UTF-8 text with ``</tag>`` ends. One task per file; text beside
    inline tags arrives unescaped, so only the listed tags are dropped from it.
    """
    raw = (
        spark.read.schema(schemas.RAW_ARTICLE)
        .option("rowTag", RECORD_TAG)
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.{xml,xml.gz}")
        .option("ignoreSurroundingSpaces", "false")
        .option("columnNameOfCorruptRecord", schemas.CORRUPT)
        .xml(path)
        .select(
            F.struct("*").alias("x"),
            F.col("_metadata.file_path").alias("source_file"),
            F.col("_metadata.file_name").alias("file_name"),
            F.col("_metadata.file_block_start").alias("block"),
        )
    )
    rows = with_doc_ids(with_sequence(raw))
    columns = _columns_from_xml(
        F.col("x"), text=lambda c: strip_tags(c, inline_tags) if inline_tags else c
    )
    return rows.select("doc_id", "source_file", *columns, F.col(f"x.{schemas.CORRUPT}"))


def order_columns(df: DataFrame) -> DataFrame:
    first = ["doc_id", "source_file"]
    return df.select(*first, *[c for c in df.columns if c not in first])


def _many(c: Column) -> Column:
    return F.coalesce(c, F.array())


def _each(c: Column, build) -> Column:
    return _many(F.transform(c, build))


def _columns_from_xml(
    x: Column, text: Callable[[Column], Column] = lambda c: c
) -> list[Column]:
    """``text`` is applied to the fields that may hold inline tags."""
    citation, data = x["MedlineCitation"], x["PubmedData"]
    article = citation["Article"]
    journal = article["Journal"]
    issue = journal["JournalIssue"]

    def author(a: Column) -> Column:
        identifier = F.get(a["Identifier"], 0)
        return F.struct(
            a["_ValidYN"].alias("valid_yn"),
            a["LastName"].alias("last_name"),
            a["ForeName"].alias("fore_name"),
            a["Initials"].alias("initials"),
            a["Suffix"].alias("suffix"),
            identifier["_Source"].alias("identifier_source"),
            identifier["_VALUE"].alias("identifier"),
            _each(
                a["AffiliationInfo"],
                lambda f: F.struct(
                    text(f["Affiliation"]).alias("affiliation"),
                    F.lit(None).cast("string").alias("institution_name"),
                    F.lit(None).cast("string").alias("country_code"),
                    F.lit(None).cast("string").alias("country_name"),
                ),
            ).alias("affiliations"),
        )

    def heading(h: Column) -> Column:
        return F.struct(
            h["DescriptorName"]["_VALUE"].alias("descriptor_name"),
            h["DescriptorName"]["_MajorTopicYN"].alias("descriptor_major_topic_yn"),
            h["DescriptorName"]["_UI"].alias("descriptor_ui"),
            _each(
                h["QualifierName"],
                lambda q: F.struct(
                    q["_VALUE"].alias("name"),
                    q["_MajorTopicYN"].alias("major_topic_yn"),
                    q["_UI"].alias("ui"),
                ),
            ).alias("qualifiers"),
        )

    def reference(r: Column) -> Column:
        return F.struct(
            text(r["Citation"]).alias("citation"),
            _each(
                r["ArticleIdList"]["ArticleId"],
                lambda i: F.struct(i["_IdType"].alias("id_type"), i["_VALUE"].alias("value")),
            ).alias("article_ids"),
        )

    def bank(b: Column) -> Column:
        return F.struct(
            b["DataBankName"].alias("name"),
            _many(b["AccessionNumberList"]["AccessionNumber"]).alias("accession_numbers"),
        )

    def lists_of(group: Column, member: str) -> Column:
        return F.flatten(F.transform(_many(group), lambda g: _many(g[member])))

    return [
        citation["PMID"]["_VALUE"].alias("pmid"),
        text(article["ArticleTitle"]).alias("title"),
        F.struct(
            journal["Title"].alias("title"),
            journal["ISOAbbreviation"].alias("iso_abbreviation"),
            issue["Volume"].alias("volume"),
            issue["Issue"].alias("issue"),
            issue["PubDate"]["Year"].alias("pub_year"),
            issue["PubDate"]["Month"].alias("pub_month"),
            issue["PubDate"]["Day"].alias("pub_day"),
        ).alias("journal"),
        _each(article["AuthorList"]["Author"], author).alias("authors"),
        _each(
            data["History"]["PubMedPubDate"],
            lambda d: F.struct(
                d["_PubStatus"].alias("pub_status"),
                d["Year"].alias("year"),
                d["Month"].alias("month"),
                d["Day"].alias("day"),
            ),
        ).alias("pub_dates"),
        _each(citation["MeshHeadingList"]["MeshHeading"], heading).alias("headings"),
        F.transform(lists_of(data["ReferenceList"], "Reference"), reference).alias("references"),
        F.struct(
            article["DataBankList"]["_CompleteYN"].alias("complete_yn"),
            _each(article["DataBankList"]["DataBank"], bank).alias("banks"),
        ).alias("databanks"),
        F.transform(
            lists_of(citation["KeywordList"], "Keyword"),
            lambda k: F.struct(
                k["_VALUE"].alias("keyword"), k["_MajorTopicYN"].alias("major_topic_yn")
            ),
        ).alias("keywords"),
    ]


# ------------------------------------------------------- XML as open-ended trees

def _element_tree(element: ElementTree.Element) -> dict:
    tree: dict = dict(element.attrib)
    for child in element:
        value = _element_tree(child)
        own_text = (child.text or "") + "".join(c.tail or "" for c in child)
        if own_text.strip() or (own_text and not len(child)):
            value["value"] = "".join(child.itertext())
        if child.tag not in tree:
            tree[child.tag] = value
        elif isinstance(tree[child.tag], list):
            tree[child.tag].append(value)
        else:
            tree[child.tag] = [tree[child.tag], value]
    return tree


@F.pandas_udf(T.StringType())
def record_json(records: pd.Series) -> pd.Series:
    """A record's whole XML as JSON: attributes become keys, an element's text
    goes to ``value``, a tag that repeats becomes a list. NULL if malformed.
    """

    def convert(record: str | None) -> str | None:
        try:
            return json.dumps(_element_tree(ElementTree.fromstring(record)), ensure_ascii=False)
        except (ElementTree.ParseError, TypeError):
            return None

    return records.map(convert)


def record_trees(records: DataFrame) -> DataFrame:
    """``doc_id, source_file, json``: every field of a citation, whatever its shape."""
    return records.select("doc_id", "source_file", record_json("record").alias("json"))


# ----------------------------------------------------------------------- JSON

def read_article_json(spark: SparkSession, path: str, layout: str = "lines") -> DataFrame:
    """``doc_id, source_file, tree`` from JSON files below ``path``; unreadable
    text gives a NULL ``tree``.

    ``layout="files"``: one object per ``*.json`` file, named by the file.
    ``layout="lines"``: the lines written by ``sinks.documents.write_documents``;
    ``source_file`` tells lines of one file apart, so copies of a document stay
    rows of their own.
    """
    reader = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.json*")
    if layout == "files":
        text = reader.option("pathGlobFilter", "*.json").text(path, wholetext=True)
        return text.select(
            F.regexp_replace("_metadata.file_name", r"\.json$", "").alias("doc_id"),
            F.col("_metadata.file_path").alias("source_file"),
            F.try_parse_json("value").alias("tree"),
        )
    if layout != "lines":
        raise ValueError(f"layout must be 'files' or 'lines', not {layout!r}")
    lines = reader.text(path).select(
        F.try_parse_json("value").alias("line"),
        F.concat_ws(
            "#", F.col("_metadata.file_path"), F.monotonically_increasing_id().cast("string")
        ).alias("source_file"),
    )
    return lines.select(
        leaf(F.col("line"), "doc_id").alias("doc_id"),
        "source_file",
        node(F.col("line"), "article").alias("tree"),
    )


def split_unreadable(trees: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(readable trees, quarantine rows)."""
    readable = F.col("tree").isNotNull()
    return trees.where(readable), unreadable(trees.where(~readable))


def unreadable(rows: DataFrame) -> DataFrame:
    return rows.select(
        F.col("source_file").alias("source"),
        "doc_id",
        F.lit("read").alias("stage"),
        F.lit("unreadable json").alias("reason"),
    )


def articles_from_trees(trees: DataFrame, keep_tree: bool = False) -> DataFrame:
    """JSON trees to article rows. A group may be an array or a single value.

    ``keep_tree`` keeps the tree itself, with the fields articles leave out.
    """
    kept = [c for c in trees.columns if keep_tree or c != "tree"]
    shaped = trees.select(*kept, shape(F.col("tree"), schemas.TREE).alias("t"))
    return order_columns(shaped.select(*kept, *_columns_from_tree(F.col("t"))))


def _columns_from_tree(t: Column) -> list[Column]:
    citation, data = t["MedlineCitation"], t["PubmedData"]
    article = citation["Article"]
    journal = article["Journal"]
    issue = journal["JournalIssue"]

    def rows_of(group: Column, ddl: str, build: Callable[[Column], Column]) -> Column:
        return F.transform(shaped_members(group, ddl), build)

    def affiliation(f: Column) -> Column:
        # An affiliation without text is still one: only a missing node is NULL.
        text = F.when(
            f["Affiliation"].isNotNull(), F.coalesce(f["Affiliation"]["value"], F.lit(""))
        )
        return F.struct(
            text.alias("affiliation"),
            f["institution_name"].alias("institution_name"),
            f["country_code"].alias("country_code"),
            f["country_name"].alias("country_name"),
        )

    def author(a: Column) -> Column:
        # A repeated identifier: the first counts.
        identifier = F.get(shaped_members(a["Identifier"], schemas.TREE_IDENTIFIER), 0)
        return F.struct(
            a["ValidYN"].alias("valid_yn"),
            a["LastName"]["value"].alias("last_name"),
            a["ForeName"]["value"].alias("fore_name"),
            a["Initials"]["value"].alias("initials"),
            a["Suffix"]["value"].alias("suffix"),
            identifier["Source"].alias("identifier_source"),
            identifier["value"].alias("identifier"),
            rows_of(a["AffiliationInfo"], schemas.TREE_AFFILIATION, affiliation).alias(
                "affiliations"
            ),
        )

    def heading(h: Column) -> Column:
        return F.struct(
            h["DescriptorName"]["value"].alias("descriptor_name"),
            h["DescriptorName"]["MajorTopicYN"].alias("descriptor_major_topic_yn"),
            h["DescriptorName"]["UI"].alias("descriptor_ui"),
            rows_of(
                h["QualifierName"],
                schemas.TREE_NAME,
                lambda q: F.struct(
                    q["value"].alias("name"),
                    q["MajorTopicYN"].alias("major_topic_yn"),
                    q["UI"].alias("ui"),
                ),
            ).alias("qualifiers"),
        )

    def reference(r: Column) -> Column:
        return F.struct(
            r["Citation"]["value"].alias("citation"),
            rows_of(
                r["ArticleIdList"]["ArticleId"],
                schemas.TREE_ARTICLE_ID,
                lambda i: F.struct(i["IdType"].alias("id_type"), i["value"].alias("value")),
            ).alias("article_ids"),
        )

    def bank(b: Column) -> Column:
        return F.struct(
            b["DataBankName"]["value"].alias("name"),
            rows_of(
                b["AccessionNumberList"]["AccessionNumber"],
                schemas.TREE_LEAF,
                lambda n: n["value"],
            ).alias("accession_numbers"),
        )

    def lists_of(group: Column, member: str) -> Column:
        # The list itself may repeat, too.
        lists = shaped_members(group, f"struct<{member}:variant>")
        return F.flatten(F.transform(lists, lambda g: one_or_many(g[member])))

    return [
        citation["PMID"]["value"].alias("pmid"),
        article["ArticleTitle"]["value"].alias("title"),
        F.struct(
            journal["Title"]["value"].alias("title"),
            journal["ISOAbbreviation"]["value"].alias("iso_abbreviation"),
            issue["Volume"]["value"].alias("volume"),
            issue["Issue"]["value"].alias("issue"),
            issue["PubDate"]["Year"]["value"].alias("pub_year"),
            issue["PubDate"]["Month"]["value"].alias("pub_month"),
            issue["PubDate"]["Day"]["value"].alias("pub_day"),
        ).alias("journal"),
        rows_of(article["AuthorList"]["Author"], schemas.TREE_AUTHOR, author).alias("authors"),
        rows_of(
            data["History"]["PubMedPubDate"],
            schemas.TREE_DATE,
            lambda d: F.struct(
                d["PubStatus"].alias("pub_status"),
                d["Year"]["value"].alias("year"),
                d["Month"]["value"].alias("month"),
                d["Day"]["value"].alias("day"),
            ),
        ).alias("pub_dates"),
        rows_of(citation["MeshHeadingList"]["MeshHeading"], schemas.TREE_HEADING, heading).alias(
            "headings"
        ),
        F.transform(
            F.transform(
                lists_of(data["ReferenceList"], "Reference"),
                lambda r: shape(r, schemas.TREE_REFERENCE),
            ),
            reference,
        ).alias("references"),
        F.struct(
            article["DataBankList"]["CompleteYN"].alias("complete_yn"),
            rows_of(article["DataBankList"]["DataBank"], schemas.TREE_BANK, bank).alias("banks"),
        ).alias("databanks"),
        F.transform(
            F.transform(
                lists_of(citation["KeywordList"], "Keyword"),
                lambda k: shape(k, schemas.TREE_NAME),
            ),
            lambda k: F.struct(
                k["value"].alias("keyword"), k["MajorTopicYN"].alias("major_topic_yn")
            ),
        ).alias("keywords"),
    ]
