"""One query per operator, over whole tables."""

from __future__ import annotations

import gzip
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from catalog import citations as C
from citelake import schemas
from citelake.functions.text import to_int
from citelake.functions.trees import leaf, members, node
from citelake.operators import dictionary, flatten, gates, integrity, keys, matching, vocabulary
from citelake.operators.enrich import country_index, enrich, organisation_index
from citelake.plans import load
from citelake.session import stage_path
from citelake.sinks import documents, tables
from citelake.sources import articles as A, files, registry
from citelake.sources.vocabulary import read_descriptors
from citelake.streaming.arrivals import start_arrivals

Query = Callable[[SparkSession, str], DataFrame]
TEXT_FILES = "*.{txt,txt.gz}"  # what Spark's text writer produces


# ------------------------------------------------------------------- matching

def org_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = C.table(spark, sf_dir, "customer").select(
        "c_custkey", F.concat("c_name", F.lit(", NATION_"), F.col("c_nationkey")).alias("text")
    )
    index = matching.build_index(C.table(spark, sf_dir, "nation"), "n_name")
    return matching.best_hits(customers, ["c_custkey"], "text", index)


def _organisation_hits(spark: SparkSession, sf_dir: str, **limits: int) -> DataFrame:
    index = organisation_index(C.organisations(spark, sf_dir), **limits)
    texts = C.affiliation_rows(C.articles(spark, sf_dir)).select(
        "doc_id", "author_pos", "affiliation_pos", "affiliation"
    )
    ids = ["doc_id", "author_pos", "affiliation_pos"]
    return matching.best_hits(texts, ids, "affiliation", index)


def org_match_indexed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _organisation_hits(spark, sf_dir, in_row_names=0)


def org_match_shuffled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _organisation_hits(spark, sf_dir, in_row_names=0, broadcast_names=0)


def passage_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    passages = C.table(spark, sf_dir, "benchmark").groupBy("text").agg(
        F.min("item_id").alias("item_id")
    )
    index = matching.build_index(passages, "text", ["item_id"])
    texts = C.table(spark, sf_dir, "documents").select("doc_id", "text")
    return matching.all_hits(texts, ["doc_id"], "text", index).select(
        "doc_id", F.col("item_id").cast("bigint").alias("item_id")
    )


# ----------------------------------------------------------------- enrichment

def _enriched(spark: SparkSession, sf_dir: str, mode: str, numbered: bool = False, **limits: int) -> DataFrame:
    """``numbered``: to be numbered next."""
    rows = C.articles(spark, sf_dir)
    return enrich(
        keys.counted(rows) if numbered else rows,
        organisation_index(C.organisations(spark, sf_dir), **limits),
        country_index(C.countries(spark, sf_dir), **limits),
        mode,
        bucketed=numbered,
    )


def enrich_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.affiliation_rows(_enriched(spark, sf_dir, "fallback"))


def enrich_fallback_indexed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.affiliation_rows(_enriched(spark, sf_dir, "fallback", in_row_names=0))


def enrich_independent_shuffled(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _enriched(spark, sf_dir, "independent", in_row_names=0, broadcast_names=0)
    return C.affiliation_rows(rows)


def enrich_independent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.affiliation_rows(_enriched(spark, sf_dir, "independent"))


# --------------------------------------------------------------- dictionaries

def _part_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    country = F.struct(
        F.col("p_brand").alias("country_code"), F.col("p_type").alias("country_name")
    )
    return C.table(spark, sf_dir, "part").select(
        F.col("p_name").alias("name"), country.alias("country"), F.col("p_partkey").alias("pos")
    )


def dictionary_last_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dictionary.organisation_dictionary(_part_registry(spark, sf_dir))


def country_last_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dictionary.country_dictionary(_part_registry(spark, sf_dir))


def _reviewed(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    suppliers = C.table(spark, sf_dir, "supplier")
    entries = suppliers.select("s_suppkey", F.concat("s_name", F.lit(" ")).alias("name"))
    sheet = suppliers.select(
        F.when(F.col("s_suppkey") % 3 == 0, "DELETE").otherwise("Keep").alias("action"),
        F.when(F.col("s_suppkey") % 2 == 0, F.upper("s_name")).otherwise("").alias("name"),
    )
    return entries, sheet


def dictionary_curate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dictionary.curate(*_reviewed(spark, sf_dir))


def review_sheet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As ``dictionary_curate``, with the sheet written as CSV files and read from them."""
    path = stage_path(spark, "sheet")
    entries, sheet = _reviewed(spark, sf_dir)
    padded = F.concat(F.lit("\t "), "name", F.lit(" ")).alias("name")
    sheet.select("action", F.lit("a, b").alias("between"), padded).write.option("header", True).csv(path)
    return dictionary.curate(entries, registry.read_review_sheet(spark, path))


def registry_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = stage_path(spark, "registry")
    documents.write_registry(_part_registry(spark, sf_dir), path)
    return dictionary.organisation_dictionary(registry.read_registry(spark, path, layout="lines"))


# ---------------------------------------------------------------------- gates

def gate_any(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gates.gate_any(_enriched(spark, sf_dir, "fallback")).select("doc_id")


def gate_with_affiliation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gates.gate_with_affiliation(_enriched(spark, sf_dir, "fallback")).select("doc_id")


def gate_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gates.gate_year(C.articles(spark, sf_dir), 2000).select("doc_id")


# --------------------------------------------------------------------- tables

def _of_articles(build: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: build(C.articles(spark, sf_dir))


def _of_numbered(build: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: build(keys.number_articles(C.articles(spark, sf_dir)))


def pubdate_recent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flatten.pubdate(C.articles(spark, sf_dir), min_year=2000)


def affiliation_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Enriched and gated articles: authors joined to their affiliations by number."""
    kept = gates.gate_any(_enriched(spark, sf_dir, "fallback", numbered=True))
    numbered = keys.number_articles(kept, staged=True, kept=["pmid", "authors"])
    return (
        flatten.author_affiliation(numbered)
        .join(flatten.author(numbered).select("author_no", "lastname"), "author_no")
        .join(flatten.affiliation(numbered).drop("pmid"), "affiliation_no")
        .select("pmid", "lastname", "affiliation", "affiliation_country", "affiliation_organization")
    )


def batch_number(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = C.table(spark, sf_dir, "orders").select("o_orderkey")
    return keys.batch_numbers(orders, ["o_orderkey"], size=1000)


def batch_folders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents written to a folder per batch: how many, and their range, as the folders tell."""
    path = stage_path(spark, "batches")
    rows = batch_number(spark, sf_dir)
    body = F.to_json(F.struct(F.struct("o_orderkey").alias("PMID"))).alias("json")
    documents.write_batches(rows.select("batch", F.col("o_orderkey").cast("string").alias("doc_id"), body), path)
    lines = spark.read.option("basePath", path).json(path, schema="doc_id string, article variant, batch bigint")
    key = F.try_variant_get("article", "$.PMID.o_orderkey", "bigint")
    return lines.groupBy("batch").agg(F.count("*").alias("n"), F.min(key).alias("low"), F.max(key).alias("high"))


def table_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All article tables written as one run, read back: rows per table."""
    out = stage_path(spark, "tables")
    load.store(C.articles(spark, sf_dir), out, "run", gate="none", min_year=2000)
    counts = [
        tables.read_table(spark, out, name)
        .agg(F.count(F.lit(1)).alias("n"))
        .select(F.lit(name).alias("name"), "n")
        for name in schemas.TABLE_COLUMNS
        if name not in ("pub_mesh_desc_list", "pub_mesh_trees")
    ]
    result = counts[0]
    for count in counts[1:]:
        result = result.unionByName(count)
    return result


def two_loaders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs stored at the same time: of each kind of number, how many rows and different numbers, and the range."""
    out = stage_path(spark, "tables")
    rows = C.articles(spark, sf_dir)
    half = F.regexp_extract("doc_id", r"(\d+)$", 1).cast("bigint") % 2

    def run(part: int) -> None:
        load.store(rows.where(half == part), out, f"run-{part}", gate="none")

    with ThreadPoolExecutor(2) as loaders:
        for _ in loaders.map(run, (0, 1)):
            pass
    kinds = {
        "author": ("pub_author", "author_no"), "affiliation": ("pub_affiliation", "affiliation_no"),
        "reference": ("pub_reference", "ref_no"), "keyword": ("pub_keyword_list", "keyword_index"),
    }
    counts = [
        tables.read_table(spark, out, name).agg(
            F.count(F.lit(1)).alias("n"), F.min(number).alias("first"), F.max(number).alias("last"),
        ).crossJoin(keys.different_numbers(tables.read_table(spark, out, name), number))
        .select(F.lit(kind).alias("kind"), "n", "numbers", "first", "last")
        for kind, (name, number) in kinds.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def load_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What became of the articles and malformed records of one load, from its run record."""
    out = stage_path(spark, "tables")
    articles = C.articles(spark, sf_dir)
    path = C.write_order_citations(spark, sf_dir, malformed=True, compressed=True)
    _, bad = A.split_malformed(A.read_articles(spark, path, glob=TEXT_FILES))
    enriched = enrich(
        articles, organisation_index(C.organisations(spark, sf_dir)), country_index(C.countries(spark, sf_dir)),
        "independent", bucketed=True,
    )
    load.store(enriched, out, "run", "any", 1995, bad, articles.count())
    return tables.load_totals(spark, out)


# ----------------------------------------------------------------- vocabulary

def mesh_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = C.write_descriptors(spark, sf_dir)
    return vocabulary.mesh_desc_list(read_descriptors(spark, path, glob=TEXT_FILES))


def mesh_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = C.write_descriptors(spark, sf_dir)
    return vocabulary.mesh_trees(read_descriptors(spark, path, glob=TEXT_FILES))


# -------------------------------------------------------------------- sources

def xml_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = C.write_line_citations(spark, sf_dir)
    author = F.get("authors", 0)
    return A.read_articles(spark, path, glob=TEXT_FILES).select(
        to_int(F.col("pmid")).alias("pmid"),
        "title",
        author["last_name"].alias("last_name"),
        author["valid_yn"].alias("valid_yn"),
        F.get(author["affiliations"], 0)["affiliation"].alias("affiliation"),
    )


def xml_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Open-ended trees of citations, and the articles read from them."""
    path = C.write_order_citations(spark, sf_dir)
    trees = A.record_trees(A.with_doc_ids(A.read_records(spark, path, glob=TEXT_FILES)))
    rows = trees.select("doc_id", "source_file", F.try_parse_json("json").alias("tree"))
    return A.articles_from_trees(rows).select(
        to_int(F.col("pmid")).alias("pmid"),
        F.get("keywords", 0)["keyword"].alias("first_keyword"),
        F.get("keywords", 1)["keyword"].alias("second_keyword"),
    )


def record_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every file's records are numbered 0, 1, … : the files whose numbers are not."""
    path = C.write_line_citations(spark, sf_dir)
    ids = A.with_doc_ids(A.read_records(spark, path, glob=TEXT_FILES)).select(
        "source_file", F.regexp_extract("doc_id", r"_(\d+)$", 1).cast("bigint").alias("pos")
    )
    per_file = ids.groupBy("source_file").agg(
        F.count(F.lit(1)).alias("n"), F.min("pos").alias("low"), F.max("pos").alias("high"),
        F.sum("pos").alias("total"),
    )
    sound = (
        (F.col("low") == 0) & (F.col("high") == F.col("n") - 1)
        & (F.col("total") == F.col("n") * (F.col("n") - 1) / 2)
    )
    return per_file.agg(
        F.sum("n").alias("records"), F.sum(F.when(sound, 0).otherwise(1)).alias("unsound_files")
    )


def record_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each record's position against its place in the file, which its own number tells."""
    records = A.with_doc_ids(A.read_records(spark, C.write_numbered_citations(spark, sf_dir), glob=TEXT_FILES))
    rows = records.select(
        "source_file", F.regexp_extract("doc_id", r"_(\d+)$", 1).cast("bigint").alias("pos"),
        F.regexp_extract("record", r"<PMID>(\d+)<", 1).cast("bigint").alias("number"),
    )
    first = rows.groupBy("source_file").agg(F.min("number").alias("first"), F.count(F.lit(1)).alias("n"))
    return rows.join(first, "source_file").agg(
        F.count(F.lit(1)).alias("records"), F.count_if(F.col("pos") == F.col("number") - F.col("first")).alias("in_order"),
    )


def json_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    tree = F.try_parse_json("props")
    return (
        C.table(spark, sf_dir, "events")
        .select("event_id", tree.alias("tree"))
        .select(
            "event_id",
            to_int(leaf(F.col("tree"), "k")).alias("k"),
            F.size(members(F.col("tree"), "k")).alias("members"),
            F.size(members(F.col("tree"), "missing")).alias("missing"),
        )
    )


def json_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Articles written as documents, read back and unfolded."""
    path = stage_path(spark, "documents")
    documents.write_documents(documents.article_json(C.articles(spark, sf_dir)), path)
    trees, _ = A.split_unreadable(A.read_article_json(spark, path))
    return C.affiliation_rows(A.articles_from_trees(trees))


def enrich_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents enriched as documents: what was found, the shape of each author's group, and the fields no row has."""
    names, out = stage_path(spark, "registry"), stage_path(spark, "enriched")
    country = F.struct("country_code", "country_name").alias("country")
    entries = C.organisations(spark, sf_dir).select("name", country, F.monotonically_increasing_id().alias("pos"))
    documents.write_registry(entries, names)
    load.enrich_json(spark, C.write_order_documents(spark, sf_dir), names, out, registry_layout="lines")
    lines = spark.read.text(out).select(F.parse_json("value").alias("line"))
    trees = lines.select(leaf(F.col("line"), "doc_id").alias("doc_id"), node(F.col("line"), "article.MedlineCitation").alias("m"))
    people = trees.select(
        "doc_id", F.to_json(node(F.col("m"), "Extra")).alias("extra"),
        F.posexplode(members(F.col("m"), "Article.AuthorList.Author")).alias("author_pos", "a"),
    )
    group = node(F.col("a"), "AffiliationInfo")
    return people.select(
        "doc_id", "extra", "author_pos", F.to_json(node(F.col("a"), "Marks")).alias("marks"),
        F.when(group.isNull(), "none").when(F.size(F.try_variant_get(group, "$", "map<string,variant>")) == 0, "empty")
        .when(F.schema_of_variant(group).startswith("ARRAY"), "list").otherwise("one").alias("shape"),
        F.posexplode_outer(members(F.col("a"), "AffiliationInfo")).alias("pos", "f"),
    ).select(
        "doc_id", "extra", "author_pos", "marks", "shape", "pos", leaf(F.col("f"), "Affiliation.value").alias("affiliation"),
        leaf(F.col("f"), "Note").alias("note"), leaf(F.col("f"), "institution_name").alias("institution_name"),
        leaf(F.col("f"), "country_code").alias("country_code"), leaf(F.col("f"), "country_name").alias("country_name"),
    )


def quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What became of every record of partly malformed files."""
    path = C.write_order_citations(spark, sf_dir, malformed=True)
    good, bad = A.split_malformed(A.read_articles(spark, path, glob=TEXT_FILES))
    outcomes = good.select(F.lit("stored").alias("status")).unionByName(
        bad.select(F.col("reason").alias("status"))
    )
    return tables.run_totals(outcomes)


def stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Citation files taken in by a stream, stored run by run, read back."""
    path = C.write_order_citations(spark, sf_dir)
    out, checkpoint = stage_path(spark, "arrivals"), stage_path(spark, "offsets")

    def handle(articles: DataFrame, bad: DataFrame, run_id: str) -> None:
        load.store(articles, out, run_id, gate="none", quarantine=bad)

    start_arrivals(spark, path, checkpoint, handle, glob=TEXT_FILES).awaitTermination()
    return tables.read_table(spark, out, "pub_keyword_list").select("pmid", "keyword")


def damaged_inputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Real gzip files, three of them damaged, in one load: what became of the records and files."""
    out = stage_path(spark, "tables")
    articles, bad = load.ingest_xml(spark, C.write_order_files(spark, sf_dir), extension="txt")
    load.store(articles, out, "run", gate="none", quarantine=bad)
    return tables.load_totals(spark, out).select("outcome", "n")


def stream_damaged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same files taken in by a stream, a few at a time."""
    path = C.write_order_files(spark, sf_dir)
    out, checkpoint = stage_path(spark, "arrivals"), stage_path(spark, "offsets")

    def handle(articles: DataFrame, bad: DataFrame, run_id: str) -> None:
        load.store(articles, out, run_id, gate="none", quarantine=bad)

    start_arrivals(spark, path, checkpoint, handle, max_files=4, glob="*.txt.gz").awaitTermination()
    return tables.load_totals(spark, out).groupBy("outcome").agg(F.sum("n").alias("n"))


def stream_enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Citation files to tables by a stream that enriches, gates and stores each micro-batch."""
    path = C.write_article_citations(spark, sf_dir)
    out, checkpoint = stage_path(spark, "arrivals"), stage_path(spark, "offsets")
    country = F.struct("country_code", "country_name").alias("country")
    entries = C.organisations(spark, sf_dir).select("name", country, F.monotonically_increasing_id().alias("pos"))
    handle = load.arrivals_handler(entries, out, gate="any", min_year=2000)
    start_arrivals(spark, path, checkpoint, handle, max_files=5, glob="*.txt.gz").awaitTermination()
    return tables.read_table(spark, out, "pub_affiliation").select(
        "pmid", "affiliation", "affiliation_country", "affiliation_organization"
    )


# ------------------------------------------------------------------ integrity

def _md5_statuses(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = C.table(spark, sf_dir, "documents").select(
        "doc_id", F.concat(F.lit("doc_"), F.col("doc_id"), F.lit(".gz")).alias("name"),
        F.col("text").cast("binary").alias("content"),
    )
    digest, case = F.md5("content"), F.col("doc_id") % 6
    checksum = (
        F.when(case == 0, F.concat(F.lit("MD5(x)= "), F.upper(digest), F.lit("\n")))
        .when(case == 1, F.concat(digest, F.lit("  x.gz")))
        .when(case == 2, F.concat(F.reverse(digest), F.lit("  x.gz")))
        .when(case == 3, digest)
        .when(case == 4, F.lit("odd text"))
    )
    sidecars = docs.where(case != 5).select("name", checksum.alias("checksum"))
    return integrity.verify_md5(docs, sidecars)


def md5_verify(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _md5_statuses(spark, sf_dir)


def run_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.run_totals(_md5_statuses(spark, sf_dir))


@F.pandas_udf(T.BinaryType())
def _gzipped(texts: pd.Series) -> pd.Series:
    return texts.map(lambda text: gzip.compress(text.encode()))


def gzip_verify(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as gzip files; of every third the last bytes are missing."""
    docs = C.table(spark, sf_dir, "documents").select(
        F.col("doc_id").cast("string").alias("name"), "doc_id", _gzipped("text").alias("content")
    )
    cut = F.substring(F.col("content"), F.lit(1), F.length("content") - 5)
    given = docs.select(
        "name",
        F.col("name").alias("path"),
        F.when(F.col("doc_id") % 3 == 0, cut).otherwise(F.col("content")).alias("content"),
    )
    return integrity.check_gzip(given).select("name", "ok")


def file_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Real files against their sidecars and through the gzip check; lines of the files that passed both."""
    path = C.write_downloads(spark, sf_dir)
    kind = F.regexp_extract("path", r"/(good|bad|large|empty)[/.]", 1).alias("kind")
    checks = load.verify_files(spark, path).join(files.read_checks(spark, path, "*.gz").select("path", "fault"), "path")
    checks = checks.select(kind, "path", "status", F.col("fault").isNotNull().alias("damaged"))
    sound = [files.literal(r.path) for r in checks.where("status = 'ok' AND NOT damaged").collect()]  # some dozens
    lines = spark.read.text(sound).select(F.col("_metadata.file_path").alias("path")).groupBy(kind).agg(F.count("*").alias("lines"))
    return checks.select("kind", "status", "damaged").distinct().join(lines, "kind", "left")


def new_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is still to be fetched when only verified files count as held."""
    suffix = F.when(F.col("doc_id") % 4 == 3, ".txt").otherwise(".gz")
    remote = C.table(spark, sf_dir, "documents").select(
        F.concat(F.lit("doc_"), F.col("doc_id"), suffix).alias("name")
    )
    return files.new_files(remote, integrity.verified(_md5_statuses(spark, sf_dir)))


QUERIES: dict[str, Query] = {
    "org_match": org_match,
    "org_match_indexed": org_match_indexed,
    "org_match_shuffled": org_match_shuffled,
    "passage_match": passage_match,
    "enrich_fallback": enrich_fallback,
    "enrich_independent": enrich_independent,
    "enrich_fallback_indexed": enrich_fallback_indexed,
    "enrich_independent_shuffled": enrich_independent_shuffled,
    "dictionary_last_wins": dictionary_last_wins,
    "country_last_wins": country_last_wins,
    "dictionary_curate": dictionary_curate,
    "review_sheet": review_sheet,
    "registry_roundtrip": registry_roundtrip,
    "gate_any": gate_any,
    "gate_with_affiliation": gate_with_affiliation,
    "gate_year": gate_year,
    "pmids": _of_articles(flatten.pmid_list),
    "pubdate_first": _of_articles(flatten.pubdate),
    "pubdate_recent": pubdate_recent,
    "titles": _of_articles(flatten.article_title),
    "journals": _of_articles(flatten.journal),
    "authors": _of_numbered(flatten.author),
    "affiliations": _of_numbered(flatten.affiliation),
    "author_affiliations": _of_numbered(flatten.author_affiliation),
    "affiliation_links": affiliation_links,
    "mesh_headings": _of_numbered(flatten.mesh_heading),
    "references_pivot": _of_numbered(flatten.reference),
    "databanks": _of_articles(flatten.databank_list),
    "keywords": _of_numbered(flatten.keyword_list),
    "batch_number": batch_number,
    "batch_folders": batch_folders,
    "table_store": table_store,
    "two_loaders": two_loaders,
    "load_totals": load_totals,
    "mesh_terms": mesh_terms,
    "mesh_trees": mesh_trees,
    "xml_articles": xml_articles,
    "xml_trees": xml_trees,
    "record_positions": record_positions,
    "record_order": record_order,
    "json_paths": json_paths,
    "json_roundtrip": json_roundtrip,
    "enrich_documents": enrich_documents,
    "quarantine": quarantine,
    "stream_ingest": stream_ingest,
    "damaged_inputs": damaged_inputs,
    "stream_damaged": stream_damaged,
    "stream_enriched": stream_enriched,
    "md5_verify": md5_verify,
    "run_totals": run_totals,
    "gzip_verify": gzip_verify,
    "file_checks": file_checks,
    "new_files": new_files,
}
