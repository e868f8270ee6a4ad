"""The whole way: citation files → articles → enriched → gated → tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from citelake import schemas
from citelake.operators import flatten, gates, integrity, keys, vocabulary
from citelake.operators.dictionary import country_dictionary, curate, organisation_dictionary
from citelake.operators.enrich import country_index, enrich, organisation_index, worked_out
from citelake.operators.matching import NameIndex
from citelake.session import spread, stage
from citelake.sinks import documents, runlog, tables
from citelake.sources import articles as source
from citelake.sources import files, registry as registries, vocabulary as vocabulary_source

GATES = {
    "none": lambda authors: F.lit(True),
    "any": gates.has_recognised,
    "with_affiliation": lambda authors: gates.has_recognised(authors, need_text=True),
}
STORED = "stored"


def outcome(gate: str, min_year: int | None) -> Column:
    """What becomes of an article: stored, or left out by the gate or the year."""
    passed = GATES[gate](F.col("authors"))
    recent = F.lit(True) if min_year is None else gates.has_year(F.col("pub_dates"), min_year)
    return F.when(~passed, "gate").when(~recent, "year").otherwise(STORED)


def ingest_records(records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Parse once into a staged table, then number within files: (articles, quarantine)."""
    parsed = stage(source.parse_records(records), "articles")
    return source.split_malformed(source.order_columns(source.with_doc_ids(parsed)))


def sound_records(
    spark: SparkSession, path: str, tag: str = source.RECORD_TAG, extension: str = "xml"
) -> tuple[DataFrame, DataFrame]:
    """Records of the files below ``path`` that are not damaged, and quarantine rows of those that are.

    Plain files are read in splits; every gzip file is inflated once, by one
    task. Files of other names that end with ``.gz`` are only checked.
    """
    plain = source.read_records(spark, path, tag, glob=f"*.{extension}")
    zipped, bad = source.gzip_records(files.read_binary(spark, path), tag)
    wanted = zipped.where(F.col("file_name").endswith(f".{extension}.gz"))
    return plain.unionByName(wanted), bad


def named_records(
    spark: SparkSession, plain: list[str], zipped: list[str], tag: str = source.RECORD_TAG
) -> tuple[DataFrame, DataFrame]:
    """As ``sound_records`` for these files, whatever their names hold."""
    records, bad = source.gzip_records(files.read_binary(spark, [files.literal(p) for p in zipped], "*"), tag) if zipped else (None, None)
    if not plain:
        return records, bad
    read = source.read_records(spark, [files.literal(p) for p in plain], tag, glob="*")
    if not zipped:
        return read, spark.createDataFrame([], schemas.QUARANTINE)
    return read.unionByName(records), bad


def ingest_xml(spark: SparkSession, path: str, extension: str = "xml") -> tuple[DataFrame, DataFrame]:
    """Articles of all XML files below ``path``, and quarantine rows. A damaged gzip file gives no article."""
    records, damaged = sound_records(spark, path, extension=extension)
    articles, malformed = ingest_records(spread(records))
    return articles, malformed.unionByName(damaged)


def ingest_json(
    spark: SparkSession, path: str, layout: str, keep_tree: bool = False
) -> tuple[DataFrame, DataFrame]:
    """Articles of all JSON files below ``path``, parsed once, and quarantine rows."""
    trees = source.read_article_json(spark, path, layout)
    marked = trees.withColumn("_readable", F.col("tree").isNotNull())
    parsed = stage(source.articles_from_trees(marked, keep_tree), "articles")
    good = parsed.where(F.col("_readable")).drop("_readable")
    return good, source.unreadable(parsed.where(~F.col("_readable")))


def registry_indexes(registry: DataFrame) -> tuple[NameIndex, NameIndex]:
    """(organisations, countries) from one staged read of the registry, which must not be empty."""
    entries = stage(registry.select("name", "country", "pos"), "registry")
    if entries.isEmpty():
        raise ValueError("the registry has no entries")
    return (
        organisation_index(organisation_dictionary(entries)),
        country_index(country_dictionary(entries)),
    )


def store(
    articles: DataFrame,
    out: str,
    run_id: str,
    gate: str = "any",
    min_year: int | None = None,
    quarantine: DataFrame | None = None,
    received: int | None = None,
) -> bool:
    """Gate, number and unfold enriched articles into tables below ``out``.

    All tables of a run become visible together. A run already published is
    left alone (False), so a repeated batch adds nothing. Any number of loaders
    may store at a time: each reserves its numbers once it knows how many.

    The run's record tells what became of its inputs: ``stored``, ``gate``,
    ``year``, with ``received`` (articles before enrichment) also ``unmatched``,
    and the quarantine rows by stage. They are counted in what was written, so
    tasks that ran twice count once.
    """
    spark = articles.sparkSession
    if tables.is_finished(spark, out, run_id):
        return False
    first = [c for c in ("doc_id", "source_file", keys.BUCKET) if c in articles.columns]
    judged = worked_out(articles, "_outcome", outcome(gate, min_year))
    # An article left out goes on as its name and outcome only.
    kept = F.col("_outcome") == STORED
    slim = judged.select(
        *first, "_outcome", *[F.when(kept, F.col(c)).alias(c) for c in articles.columns if c not in first]
    )
    log = runlog.RunLog(spark, out)
    placed = keys.number_articles(slim, lambda sizes: log.reserve(run_id, sizes), staged=True)
    result = flatten.flatten_articles(placed.where(kept).drop("_outcome"), min_year)
    if quarantine is not None:
        result["quarantine"] = quarantine
    attempt = tables.write_tables(result, out, run_id)
    totals = {r[0]: r[1] for r in placed.groupBy("_outcome").count().collect()}
    if received is not None:
        totals["unmatched"] = received - sum(totals.values())
    if quarantine is not None:
        written = spark.read.schema(schemas.QUARANTINE).parquet(tables.attempt_path(out, "quarantine", run_id, attempt))
        totals |= {r[0]: r[1] for r in written.groupBy("stage").count().collect()}
    return tables.publish(spark, out, run_id, attempt, totals)


def arrivals_handler(
    registry: DataFrame,
    out: str,
    mode: str = "fallback",
    gate: str = "any",
    min_year: int | None = None,
) -> Callable[[DataFrame, DataFrame, str], bool]:
    """A handler for ``streaming.arrivals``: enrich each micro-batch, then store it as a run.

    The registry is read and indexed once, before the first batch.
    """
    indexes = registry_indexes(registry)

    def handle(articles: DataFrame, quarantine: DataFrame, run_id: str) -> bool:
        enriched = enrich(articles, *indexes, mode, bucketed=True)
        return store(enriched, out, run_id, gate, min_year, quarantine, articles.count())

    return handle


def convert_xml(spark: SparkSession, path: str, out: str) -> DataFrame:
    """Every citation as a JSON document with all its fields; returns quarantine rows of damaged files."""
    records, damaged = sound_records(spark, path)
    trees = source.record_trees(source.with_doc_ids(stage(records, "records")))
    documents.write_documents(trees, out)
    return damaged


def enrich_json(
    spark: SparkSession,
    path: str,
    registry_path: str,
    out: str,
    mode: str = "fallback",
    layout: str = "lines",
    batch_size: int | None = None,
    registry_layout: str = "array",
) -> DataFrame:
    """Enriched documents below ``out``, otherwise as they were; returns quarantine rows.

    With ``batch_size`` the documents go to folders of that many inputs each,
    counted before any is left out.
    """
    articles, unreadable = ingest_json(spark, path, layout, keep_tree=True)
    entries = registries.read_registry(spark, registry_path, layout=registry_layout)
    indexes = registry_indexes(entries)
    if batch_size is None:
        documents.write_documents(documents.enriched_json(enrich(articles, *indexes, mode)), out)
        return unreadable
    batches = keys.batch_numbers(
        articles.select("doc_id", "source_file"), ["doc_id", "source_file"], batch_size
    )
    enriched = enrich(articles, *indexes, mode).join(batches, ["doc_id", "source_file"])
    documents.write_batches(documents.enriched_json(enriched, ["batch"]), out)
    return unreadable


def load_json(
    spark: SparkSession,
    path: str,
    out: str,
    run_id: str,
    gate: str = "any",
    min_year: int | None = None,
    layout: str = "lines",
) -> bool:
    """Tables from enriched documents."""
    articles, unreadable = ingest_json(spark, path, layout)
    return store(articles, out, run_id, gate, min_year, unreadable)


def load_xml(
    spark: SparkSession,
    path: str,
    registry_path: str,
    out: str,
    run_id: str,
    mode: str = "fallback",
    gate: str = "any",
    min_year: int | None = None,
    registry_layout: str = "array",
) -> bool:
    """XML files to tables without documents in between."""
    articles, quarantine = ingest_xml(spark, path)
    entries = registries.read_registry(spark, registry_path, layout=registry_layout)
    indexes = registry_indexes(entries)
    enriched = enrich(articles, *indexes, mode, bucketed=True)
    return store(enriched, out, run_id, gate, min_year, quarantine, articles.count())


def load_vocabulary(spark: SparkSession, path: str, out: str, run_id: str) -> bool:
    """The two vocabulary tables."""
    if tables.is_finished(spark, out, run_id):
        return False
    records, damaged = sound_records(spark, path, vocabulary_source.RECORD_TAG)
    parsed = stage(
        vocabulary_source.parse_descriptors(source.with_doc_ids(records)), "descriptors"
    )
    good, bad = source.split_malformed(parsed)
    result = vocabulary.flatten_descriptors(good)
    result["quarantine"] = bad.unionByName(damaged)
    return tables.publish(spark, out, run_id, tables.write_tables(result, out, run_id))


def curate_registry(spark: SparkSession, registry_path: str, sheet_path: str, out: str) -> None:
    entries = registries.read_registry(spark, registry_path, whole=True)
    documents.write_registry(curate(entries, registries.read_review_sheet(spark, sheet_path)), out)


def verify_files(spark: SparkSession, path: str) -> DataFrame:
    """``name, path, status`` of every ``.gz`` file against its sidecar; files of any size, empty ones included."""
    return integrity.verify_md5(files.read_checks(spark, path, "*.gz"), files.checked_sidecars(spark, path))
