import gzip
import json
import os

import pytest

from citelake import schemas
from citelake.__main__ import main
from citelake.operators import keys
from citelake.operators.dictionary import country_dictionary, organisation_dictionary
from citelake.operators.enrich import country_index, enrich, organisation_index
from citelake.plans import load
from citelake.sinks import documents, tables
from citelake.sources import articles as A
from citelake.sources.registry import read_registry
from citelake.streaming.arrivals import start_arrivals
from tests import samples as S


@pytest.fixture
def inputs(put, tmp_path):
    put("xml/a.xml", S.article_set(S.FULL, S.BROKEN, S.BARE))
    put("xml/b.xml.gz", S.article_set(S.SINGLE))
    put("xml/cut.xml.gz", gzip.compress(S.article_set(*[S.FULL] * 50).encode())[:150])
    put("reg/orgs.json", S.REGISTRY)
    return tmp_path


def rows(spark, out, name):
    return [tuple(r) for r in tables.read_table(spark, str(out), name).collect()]


def test_xml_to_tables(spark, inputs):
    out = inputs / "out"
    args = (spark, str(inputs / "xml"), str(inputs / "reg"), str(out))
    assert load.load_xml(*args, run_id="r1")
    assert sorted(rows(spark, out, "pub_pmid_list")) == [(101,), (102,)]
    stored = {(r[2], r[3], r[4]) for r in rows(spark, out, "pub_affiliation")}
    assert stored == {
        ("Univ X Hospital, Norland", "SU", "Univ X Hospital"),
        ("Univ X, H2O Dept, Sudland", "NO", "Univ X"),
        ("Univ X, Norland", "NO", "Univ X")}
    # In = stored + gated out + set aside; the cut file counts as one.
    reasons = sorted((r[2], r[3]) for r in rows(spark, out, "quarantine"))
    assert reasons == [("gunzip", "unexpected end of file"), ("parse", "malformed")]
    # The same run again changes nothing; another run continues the numbers.
    assert not load.load_xml(*args, run_id="r1")
    assert load.load_xml(*args, run_id="r2", min_year=2014)
    numbers = sorted(r[1] for r in rows(spark, out, "pub_author"))
    assert numbers == [1, 2, 3, 4, 5, 6]
    for name in schemas.TABLE_COLUMNS:
        if not name.startswith("pub_mesh_desc") and name != "pub_mesh_trees":
            assert rows(spark, out, name), name


def test_unfinished_run_is_invisible(spark, inputs, monkeypatch):
    out = inputs / "out"
    args = (spark, str(inputs / "xml"), str(inputs / "reg"), str(out))
    assert load.load_xml(*args, run_id="r1")

    def fail(*_, **__):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(load.tables, "publish", fail)
        with pytest.raises(RuntimeError):
            load.load_xml(*args, run_id="r2")
    assert len(rows(spark, out, "pub_author")) == 3
    assert load.load_xml(*args, run_id="r2")
    assert sorted(r[1] for r in rows(spark, out, "pub_author")) == [1, 2, 3, 4, 5, 6]


def test_documents_way_gives_the_same_tables(spark, inputs):
    direct, staged = inputs / "direct", inputs / "staged"
    good = inputs / "good"
    good.mkdir()
    for name in ("a.xml", "b.xml.gz"):
        os.link(inputs / "xml" / name, good / name)
    load.load_xml(spark, str(good), str(inputs / "reg"), str(direct), "r", mode="independent")
    load.convert_xml(spark, str(good), str(inputs / "json"))
    lines = spark.read.text(str(inputs / "json")).collect()
    assert {json.loads(r.value)["doc_id"] for r in lines} == {"a_0", "a_1", "a_2", "b_0"}
    # The malformed record has no tree and is reported on reading.
    bad = load.enrich_json(
        spark, str(inputs / "json"), str(inputs / "reg"), str(inputs / "enriched"),
        mode="independent", batch_size=1)
    assert [r.doc_id for r in bad.collect()] == ["a_1"]
    # Three inputs were counted, two of them kept.
    batches = {p for p in os.listdir(inputs / "enriched") if p.startswith("batch")}
    assert len(batches) == 2 and batches < {"batch=1", "batch=2", "batch=3"}
    load.load_json(spark, str(inputs / "enriched"), str(staged), "r")
    for name in ("pub_affiliation", "pub_mesh_heading", "pub_reference", "pub_databank_list"):
        drop = [c for c in ("affiliation_no", "descriptor_index", "ref_no")]
        a, b = (
            sorted(map(str, tables.read_table(spark, str(o), name).drop(*drop).collect()))
            for o in (direct, staged))
        assert a == b and a, name


def test_article_json_round_trip(spark, inputs):
    articles, _ = A.split_malformed(A.read_articles(spark, str(inputs / "xml" / "a.xml")))
    path = str(inputs / "docs")
    documents.write_documents(documents.article_json(articles), path)
    back = A.articles_from_trees(A.read_article_json(spark, path))
    order = lambda df: sorted(df.drop("source_file").collect(), key=lambda r: r.doc_id)
    assert order(back) == order(articles)


def test_copies_of_a_document_stay_apart(spark, put, tmp_path):
    tree = {"MedlineCitation": {"PMID": {"value": "7"}, "Article": {"AuthorList": {"Author": {
        "AffiliationInfo": {"Affiliation": {"value": "x"}, "country_code": "C", "institution_name": "I"}}}}}}
    line = json.dumps({"doc_id": "same", "article": tree})
    put("docs/part.json", "\n".join([line] * 50 + ["{bad"]) + "\n")
    out = str(tmp_path / "out")
    load.load_json(spark, str(tmp_path / "docs"), out, "r")
    assert sorted(r[1] for r in rows(spark, out, "pub_author")) == list(range(1, 51))
    links = rows(spark, out, "pub_author_affiliation")
    assert len({r[1] for r in links}) == len({r[2] for r in links}) == 50
    assert len(rows(spark, out, "quarantine")) == 1


def test_vocabulary_and_curation_and_cli(spark, put, inputs, monkeypatch):
    put("mesh/desc.xml", S.MESH)
    put("sheet.csv", "a,n,name\nDelete,1,univ x\n")
    monkeypatch.setattr("citelake.__main__.get_spark", lambda: spark)
    out = str(inputs / "voc")
    main(["load-vocabulary", str(inputs / "mesh"), out, "v1"])
    assert len(rows(spark, out, "pub_mesh_trees")) == 3
    main(["curate", str(inputs / "reg"), str(inputs / "sheet.csv"), str(inputs / "curated")])
    left = spark.read.json(str(inputs / "curated"))
    assert sorted(r.id for r in left.collect()) == ["r2", "r3", "r4", "r5", "r6"]
    again = read_registry(spark, str(inputs / "curated"), layout="lines")
    orgs = {r.name: r.country_code for r in organisation_dictionary(again).collect()}
    assert orgs == {"Univ X Hospital": "SU", "Dup": "XX", "Stateless Lab": ""}


def test_each_arrival_once(spark, put, tmp_path):
    put("in/a.xml", S.article_set(S.FULL, S.BARE))
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "check")

    def handle(articles, quarantine, run_id):
        load.store(articles, out, run_id, gate="none", quarantine=quarantine)

    def run():
        query = start_arrivals(spark, str(tmp_path / "in"), checkpoint, handle)
        query.awaitTermination()
        return sorted(r[0] for r in rows(spark, out, "pub_pmid_list"))

    assert run() == [101, 103]
    put("in/b.xml.gz", S.article_set(S.SINGLE, S.BROKEN))
    assert run() == [101, 102, 103]
    assert run() == [101, 102, 103]
    assert [r[1] for r in rows(spark, out, "quarantine")] == ["b_1"]
    numbers = sorted(r[1] for r in rows(spark, out, "pub_author"))
    assert numbers == [1, 2, 3]


def test_jdbc_options(spark, monkeypatch):
    """The writer's settings only; no database is started here."""
    seen = {}
    from pyspark.sql.readwriter import DataFrameWriter

    options = {}
    original = DataFrameWriter.option

    def option(self, key, value):
        options[key] = value
        return original(self, key, value)

    def save(self, *_, **__):
        seen[options["dbtable"]] = dict(options)

    monkeypatch.setattr(DataFrameWriter, "option", option)
    monkeypatch.setattr(DataFrameWriter, "save", save)
    df = spark.range(1)
    tables.write_jdbc({"pub_pmid_list": df, "pub_author": df}, "jdbc:x:y", prefix="new_")
    assert set(seen) == {"new_pub_pmid_list", "new_pub_author"}
    assert seen["new_pub_author"]["batchsize"] == 10_000


def test_run_totals(spark):
    df = spark.createDataFrame([("ok",), ("ok",), ("mismatch",)], "status string")
    assert sorted(map(tuple, tables.run_totals(df).collect())) == [("mismatch", 1), ("ok", 2)]


def test_articles_are_shuffled_once(spark, put, tmp_path, monkeypatch):
    """Large dictionaries, hits joined, gated, numbered: one exchange carries the authors. Same numbers as without buckets."""
    body = [S.FULL.replace(">101<", f">{i}<") for i in range(60)] + [S.SINGLE, S.BARE]
    put("xml/a.xml", S.article_set(*body))
    articles, _ = load.ingest_xml(spark, str(tmp_path / "xml"))
    put("reg/orgs.json", S.REGISTRY)
    entries = read_registry(spark, str(tmp_path / "reg"))
    large = {"in_row_names": 0, "broadcast_names": 0}
    indexes = (
        organisation_index(organisation_dictionary(entries), **large), country_index(country_dictionary(entries), **large))
    plans, stage = [], keys.stage
    monkeypatch.setattr(keys, "stage", lambda df, name: plans.append((name, df)) or stage(df, name))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    rows = {}
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        for bucketed in (False, True):
            plans.clear()
            out = str(tmp_path / f"out{bucketed}")
            assert load.store(enrich(articles, *indexes, "fallback", bucketed=bucketed), out, "r", "any", 2014)
            names = ("pub_author", "pub_affiliation", "pub_author_affiliation", "pub_keyword_list")
            rows[bucketed] = [sorted(map(str, tables.read_table(spark, out, n).collect())) for n in names]
            placed = dict(plans)["placed"]._jdf.queryExecution().executedPlan()
            carried = wide_exchanges(placed.toString())
            assert carried == (1 if bucketed else 2), placed.toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert rows[True] == rows[False] and rows[True][0]


def wide_exchanges(plan):
    """How many exchanges stand above a scan of the articles' titles without another between."""
    count, lines = 0, plan.split("\n")
    for at, line in enumerate(lines):
        if "Exchange hashpartitioning" in line:
            depth = line.index("Exchange")
            below = []
            for other in lines[at + 1 :]:
                here = next((i for i, c in enumerate(other) if c.isalpha() or c == "*"), 0)
                if here <= depth:
                    break
                below.append(other)
            count += any("FileScan" in b and "title" in b for b in below)
    return count
