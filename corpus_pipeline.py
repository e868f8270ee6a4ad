"""The corpus pipeline: documents to token files, one operator a stage.

Each stage takes ``(spark, docs, sf_dir)`` and works on all rows that the
stage before it kept; all but the last return the columns of ``docs``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from citelake.llm.decontaminate import clean_documents
from citelake.llm.mixing import mixed_documents
from citelake.llm.near_dups import one_of_each_group
from citelake.llm.token_files import token_index, write_tokens
from citelake.llm.toxicity import without_toxic
from citelake.session import stage, stage_path


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents not predicted toxic; the model is fitted on the labelled ones among ``docs``."""
    return without_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, by five-word shingles."""
    return one_of_each_group(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that overlap no benchmark passage."""
    return clean_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    return mixed_documents(docs)


def write_token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of the files written, one row per document taken."""
    path = stage_path(spark, "tokens")
    write_tokens(docs, path)
    return token_index(spark, path)


STAGES = [
    ("drop_toxic", drop_toxic),
    ("drop_near_duplicates", drop_near_duplicates),
    ("drop_contaminated", drop_contaminated),
    ("mix_sources", mix_sources),
    ("write_token_files", write_token_files),
]

#: Trained models, hashes and a tokenizer are not for SQL; the tests hold the stages to plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``, each result written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, apply in STAGES[:-1]:
        docs = stage(apply(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
