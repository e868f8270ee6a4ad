"""Citations made from the rows of the given tables.

The tables hold no citations, so each ``orders`` row becomes one article: its
authors, dates, headings and so on are arrays worked out from the row's own
columns. Nothing is grouped, so no key can gather an unbounded article.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from citelake.functions.trees import held_once
from citelake.session import spread, stage_path
from citelake.sinks.documents import COMPRESSED, PER_FILE
from citelake.sources.files import read_checks


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spread(spark.read.parquet(f"{sf_dir}/{name}.parquet"))


def _up_to(n: Column) -> Column:
    """``[0, …, n-1]``, empty for 0."""
    return F.when(n > 0, F.sequence(F.lit(0), n.cast("int") - 1)).otherwise(
        F.array().cast("array<int>")
    )


def _each(n: Column, build) -> Column:
    return F.transform(_up_to(n), build)


def _text(c: Column) -> Column:
    return c.cast("string")


def _flag(c: Column) -> Column:
    return F.when(c, "Y").otherwise("N")


def articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    key, customer = F.col("o_orderkey"), F.col("o_custkey")
    date = F.col("o_orderdate")
    year, month, day = F.year(date), F.month(date), F.dayofmonth(date)

    def affiliation(i: Column):
        def build(j: Column) -> Column:
            supplier = F.lpad(_text((customer * (i + 1) * 3 + j) % 400), 9, "0")
            place = F.when(
                (key + j) % 11 == 0, F.lit("Elsewhere")
            ).otherwise(F.concat(F.lit("NATION_"), _text((key + i + j) % 40)))
            text = F.concat(
                F.lit("Dept "), F.col("o_orderpriority"), F.lit(", Supplier#"), supplier,
                F.lit(", "), place,
            )
            # Some affiliations have no text but come with earlier values.
            known = (customer % 13 == 0) & (j == 1)
            return F.struct(
                F.when(~known, text).alias("affiliation"),
                F.when(known, F.lit("Known")).alias("institution_name"),
                F.when(known, F.lit("KN")).alias("country_code"),
                F.when(known, F.lit("Knownland")).alias("country_name"),
            )

        return build

    def author(i: Column) -> Column:
        identified = customer % 2 == 0
        return F.struct(
            _flag((customer + i) % 7 != 0).alias("valid_yn"),
            F.concat(F.lit("Customer#"), _text(customer + i)).alias("last_name"),
            F.when(i != 1, F.col("o_orderpriority")).alias("fore_name"),
            F.col("o_orderstatus").alias("initials"),
            F.when(i == 3, F.lit("Jr")).alias("suffix"),
            F.when(identified, F.lit("ORCID")).alias("identifier_source"),
            F.when(identified, _text(customer)).alias("identifier"),
            _each((customer + i) % 3, affiliation(i)).alias("affiliations"),
        )

    def date_of(status: Column, y: Column, m: Column, d: Column) -> Column:
        return F.struct(
            status.alias("pub_status"), _text(y).alias("year"), m.alias("month"), d.alias("day")
        )

    dates = F.array(
        date_of(F.lit("received"), year, _text(month), _text(day)),
        date_of(
            F.when(F.col("o_orderstatus") == "F", "accepted").otherwise("pubmed"),
            year,
            F.when(key % 3 == 0, F.lit("Jul")).otherwise(_text(month)),
            F.concat(_text(day), F.lit(".0")),
        ),
        date_of(F.lit("pubmed"), year + 1, F.concat(F.lit(" "), _text(month)), F.lit("31")),
    )

    def heading(k: Column) -> Column:
        return F.struct(
            F.concat(F.lit("Heading "), _text((customer + k) % 50)).alias("descriptor_name"),
            _flag(k == 0).alias("descriptor_major_topic_yn"),
            F.concat(F.lit("D"), _text((customer + k) % 50)).alias("descriptor_ui"),
            _each(
                (key + k) % 3,
                lambda q: F.struct(
                    F.concat(F.lit("Qualifier "), _text(q)).alias("name"),
                    _flag(q == 1).alias("major_topic_yn"),
                    F.concat(F.lit("Q"), _text(q)).alias("ui"),
                ),
            ).alias("qualifiers"),
        )

    def reference(k: Column) -> Column:
        def article_id(kind: Column, value: Column) -> Column:
            return F.struct(kind.alias("id_type"), value.alias("value"))

        return F.struct(
            F.concat(F.lit("Ref "), _text(key), F.lit("."), _text(k)).alias("citation"),
            F.array(
                article_id(F.lit("DOI"), F.concat(F.lit("10.1/"), _text(key))),
                article_id(
                    F.when(k == 1, F.lit("doi")).otherwise("other"),
                    F.concat(F.lit("10.2/"), _text(key)),
                ),
                article_id(
                    F.when(customer % 2 == 0, F.lit("PubMed")).otherwise("PMCID"),
                    _text(customer),
                ),
            ).alias("article_ids"),
        )

    def bank(b: Column) -> Column:
        return F.struct(
            F.concat(F.lit("Bank "), _text(b)).alias("name"),
            _each((key + b) % 3, lambda n: F.concat_ws(".", _text(key), _text(b), _text(n))).alias(
                "accession_numbers"
            ),
        )

    return table(spark, sf_dir, "orders").select(
        F.concat(F.lit("order_"), _text(key)).alias("doc_id"),
        F.lit("orders").alias("source_file"),
        _text(key).alias("pmid"),
        F.when(key % 9 != 0, F.concat_ws(" ", F.lit("Order"), _text(key), "o_orderpriority")).alias(
            "title"
        ),
        F.struct(
            F.col("o_orderpriority").alias("title"),
            F.when(customer % 3 != 0, F.col("o_orderstatus")).alias("iso_abbreviation"),
            _text(year).alias("volume"),
            _text(month).alias("issue"),
            _text(year).alias("pub_year"),
            F.date_format(date, "MM").alias("pub_month"),
            F.when(key % 4 != 0, _text(day)).alias("pub_day"),
        ).alias("journal"),
        _each(key % 5, author).alias("authors"),
        dates.alias("pub_dates"),
        _each(customer % 3, heading).alias("headings"),
        _each(key % 3, reference).alias("references"),
        F.struct(
            _flag(key % 2 == 0).alias("complete_yn"), _each(customer % 3, bank).alias("banks")
        ).alias("databanks"),
        F.transform(
            F.split("o_orderpriority", "-"),
            lambda w: F.struct(w.alias("keyword"), _flag(w == "LOW").alias("major_topic_yn")),
        ).alias("keywords"),
    )


def organisations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every supplier, and for every tenth a longer name as well."""
    suppliers = table(spark, sf_dir, "supplier")
    nations = table(spark, sf_dir, "nation")
    plain = suppliers.join(nations, F.col("s_nationkey") == F.col("n_nationkey")).select(
        F.col("s_name").alias("name"),
        F.concat(F.lit("C"), _text(F.col("s_nationkey"))).alias("country_code"),
        F.col("n_name").alias("country_name"),
        "s_suppkey",
    )
    longer = plain.where(F.col("s_suppkey") % 10 == 0).select(
        F.concat("name", F.lit(", NATION_1")).alias("name"),
        F.lit("").alias("country_code"),
        F.lit("").alias("country_name"),
        "s_suppkey",
    )
    return plain.unionByName(longer).drop("s_suppkey")


def countries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "nation").select(
        F.col("n_name").alias("country_name"),
        F.concat(F.lit("C"), _text(F.col("n_nationkey"))).alias("country_code"),
    )


def affiliation_rows(rows: DataFrame) -> DataFrame:
    """``doc_id, author_pos, affiliation_pos`` and the affiliation's fields."""
    return (
        rows.select("doc_id", F.posexplode("authors").alias("author_pos", "a"))
        .select("doc_id", "author_pos", F.posexplode("a.affiliations").alias("affiliation_pos", "f"))
        .select("doc_id", "author_pos", "affiliation_pos", "f.*")
    )


def _element(name: str, *content: Column | str) -> Column:
    inner = [F.lit(c) if isinstance(c, str) else c for c in content]
    return F.concat(F.lit(f"<{name}>"), *inner, F.lit(f"</{name}>"))


def write_line_citations(spark: SparkSession, sf_dir: str) -> str:
    """Every ``lineitem`` row as citation XML below a fresh shared folder."""
    path = stage_path(spark, "lines-xml")
    escaped = F.concat(F.lit("Line &lt;"), _text(F.col("l_linenumber")), F.lit("&gt; <i>of</i> "))
    authors = F.concat(
        F.lit('<Author ValidYN="Y">'),
        _element("LastName", F.concat(F.lit("S"), _text(F.col("l_suppkey")))),
        _element(
            "AffiliationInfo",
            _element("Affiliation", F.concat(F.lit("Part "), _text(F.col("l_partkey")))),
        ),
        F.lit("</Author>"),
    )
    record = _element(
        "PubmedArticle",
        _element(
            "MedlineCitation",
            F.concat(F.lit('<PMID Version="1">'), _text(F.col("l_orderkey")), F.lit("</PMID>")),
            _element(
                "Article",
                _element("ArticleTitle", escaped, F.col("l_returnflag")),
                _element("AuthorList", authors),
            ),
        ),
    )
    _write_compressed(table(spark, sf_dir, "lineitem").select(record.alias("value")), path)
    return path


def _write_compressed(lines: DataFrame, path: str) -> None:
    """Texts as gzip files: their tags repeat, so plain ones take some twenty times the disk. No file is cut when it is read, so each is small."""
    lines.write.options(maxRecordsPerFile=PER_FILE, **COMPRESSED).text(path)


def write_numbered_citations(spark: SparkSession, sf_dir: str) -> str:
    """Every ``lineitem`` row as a citation whose id grows by one from record to record of a file."""
    path = stage_path(spark, "numbered-xml")
    record = _element("PubmedArticle", _element("MedlineCitation", _element("PMID", _text(F.monotonically_increasing_id()))))
    table(spark, sf_dir, "lineitem").select(record.alias("value")).write.text(path)
    return path


def write_order_citations(spark: SparkSession, sf_dir: str, malformed: bool = False, compressed: bool = False) -> str:
    """Every order as a small XML citation; every tenth not well-formed, and in gzip files, if asked."""
    path = stage_path(spark, "orders-xml")
    key = F.col("o_orderkey")
    end = F.lit("</PMID>")
    if malformed:
        end = F.when(key % 10 == 0, F.lit("</PMI>")).otherwise(end)
    pmid = F.concat(F.lit("<PMID>"), _text(key), end)
    keywords = _element(
        "KeywordList", _element("Keyword", F.col("o_orderpriority")),
        _element("Keyword", F.col("o_orderstatus")),
    )
    record = _element("PubmedArticle", _element("MedlineCitation", pmid, keywords))
    lines = table(spark, sf_dir, "orders").select(record.alias("value"))
    if compressed:
        _write_compressed(lines, path)
    else:
        lines.write.text(path)
    return path


def write_order_files(spark: SparkSession, sf_dir: str) -> str:
    """Orders as gzip files; every tenth record is not well-formed, and every fourth order is in one of three files that are no gzip."""
    path = stage_path(spark, "orders-gz")
    rows = spark.read.text(write_order_citations(spark, sf_dir, malformed=True))
    key = F.regexp_extract("value", r"<PMID>(\d+)<", 1).cast("bigint")
    rows.where(key % 4 != 3).write.option("compression", "gzip").text(f"{path}/good")
    rows.where(key % 4 == 3).repartition(3, "value").write.text(f"{path}/bad")
    hadoop = spark._jvm.org.apache.hadoop.fs
    folder = hadoop.Path(f"{path}/bad")
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    for status in fs.listStatus(folder):
        if status.getPath().getName().endswith(".txt"):
            fs.rename(status.getPath(), status.getPath().suffix(".gz"))
    return path


def write_order_documents(spark: SparkSession, sf_dir: str) -> str:
    """Orders as JSON documents in the shapes that occur: none, one or several authors, each with no, one or several
    affiliations; and fields that no article row has.
    """
    path = stage_path(spark, "orders-json")

    def author(a: Column) -> Column:
        infos = F.transform(
            a["affiliations"],
            lambda f, j: F.to_json(F.struct(
                F.struct(F.coalesce(f["affiliation"], F.lit("")).alias("value")).alias("Affiliation"),
                F.concat(F.lit("note "), _text(j)).alias("Note"),
            )),
        )
        rest = F.to_json(F.struct(
            F.struct(a["last_name"].alias("value")).alias("LastName"),
            F.array(a["initials"], F.lit(None).cast("string")).alias("Marks"),
        ))
        # A group that is missing has no key at all.
        group = F.concat(F.lit('{"AffiliationInfo":'), _one_or_list(infos), F.lit(","))
        return F.concat(F.coalesce(group, F.lit("{")), F.substr(rest, F.lit(2)))

    group = _one_or_list(F.transform("authors", author))
    line = F.concat(
        F.lit('{"doc_id":"'), "doc_id", F.lit('","article":{"MedlineCitation":{"PMID":{"value":"'), "pmid",
        F.lit('"},"Extra":{"of":'), "pmid", F.lit(',"more":[true,{}]},"Article":{'),
        F.coalesce(F.concat(F.lit('"AuthorList":{"CompleteYN":"Y","Author":'), group, F.lit("}")), F.lit("")), F.lit("}}}}"),
    )
    # Lines of JSON as they are: from variants Spark writes every text through a generator of its own.
    lines = articles(spark, sf_dir).select(F.coalesce(line, F.lit("{}")).alias("value"))
    _write_compressed(lines, path)
    _renamed(spark, path, ".txt.gz", ".json.gz")
    return path


def _one_or_list(texts: Column) -> Column:
    """JSON texts as the JSON of their group: one as it is, several as a list, NULL without any."""
    def joined(texts: Column) -> Column:
        many = F.concat(F.lit("["), F.array_join(texts, ","), F.lit("]"))
        return F.when(F.size(texts) > 1, many).when(F.size(texts) == 1, F.get(texts, 0))

    return held_once(texts, joined)


def _renamed(spark: SparkSession, path: str, end: str, new: str) -> None:
    """The files of folder ``path`` that end with ``end`` end with ``new`` from now on."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    folder = hadoop.Path(path)
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    for status in fs.listStatus(folder):
        name = status.getPath().getName()
        if name.endswith(end) and not name.startswith((".", "_")):
            fs.rename(status.getPath(), hadoop.Path(folder, name.removesuffix(end) + new))


def write_article_citations(spark: SparkSession, sf_dir: str) -> str:
    """The authors, affiliations and dates of ``articles`` as citation XML, in gzip files; affiliations without text have none here either."""
    path = stage_path(spark, "articles-xml")

    def joined(values: Column, build) -> Column:
        return F.array_join(F.transform(values, build), "")

    def author(a: Column) -> Column:
        infos = joined(
            a["affiliations"],
            lambda f: _element("AffiliationInfo", F.coalesce(_element("Affiliation", f["affiliation"]), F.lit(""))),
        )
        return F.concat(F.lit('<Author ValidYN="'), a["valid_yn"], F.lit('">'), _element("LastName", a["last_name"]), infos, F.lit("</Author>"))

    def date(d: Column) -> Column:
        return F.concat(F.lit('<PubMedPubDate PubStatus="'), d["pub_status"], F.lit('">'), _element("Year", d["year"]), F.lit("</PubMedPubDate>"))

    record = _element(
        "PubmedArticle",
        _element(
            "MedlineCitation", _element("PMID", F.col("pmid")),
            _element("Article", _element("AuthorList", joined(F.col("authors"), author))),
        ),
        _element("PubmedData", _element("History", joined(F.col("pub_dates"), date))),
    )
    articles(spark, sf_dir).select(record.alias("value")).write.option("compression", "gzip").text(path)
    return path


def write_downloads(spark: SparkSession, sf_dir: str) -> str:
    """The files of ``write_order_files``, all ``lineitem`` rows in a file a partition, a file of no bytes; sidecars, of the damaged files wrong ones."""
    path = write_order_files(spark, sf_dir)
    lines = table(spark, sf_dir, "lineitem").select(F.to_json(F.struct("*")).alias("value"))
    lines.write.option("compression", "gzip").text(f"{path}/large")
    hadoop = spark._jvm.org.apache.hadoop.fs
    fs = hadoop.Path(path).getFileSystem(spark._jsc.hadoopConfiguration())
    found = read_checks(spark, path, "*.gz").select("path", "md5").collect()  # some dozens of files
    fs.create(hadoop.Path(f"{path}/empty.gz")).close()
    for file in found:
        digest = "0" * 32 if "/bad/" in file.path else file.md5.upper()
        stream = fs.create(hadoop.Path(f"{file.path}.md5"))
        stream.write(bytearray(f"MD5(x)= {digest}\n".encode()))
        stream.close()
    return path


def write_descriptors(spark: SparkSession, sf_dir: str) -> str:
    """Every part as a vocabulary record with two tree numbers, or none."""
    path = stage_path(spark, "parts-xml")
    key = F.col("p_partkey")
    trees = F.when(
        key % 5 != 0,
        _element(
            "TreeNumberList",
            _element("TreeNumber", F.concat(F.col("p_type"), F.lit("."), _text(key))),
            _element("TreeNumber", F.concat(F.col("p_brand"), F.lit("."), _text(F.col("p_size")))),
        ),
    ).otherwise("")
    record = F.concat(
        F.lit('<DescriptorRecord DescriptorClass="1">'),
        _element("DescriptorUI", F.concat(F.lit("D"), _text(key))),
        _element("DescriptorName", _element("String", F.col("p_name"))),
        trees,
        F.lit("</DescriptorRecord>"),
    )
    table(spark, sf_dir, "part").select(record.alias("value")).write.text(path)
    return path

