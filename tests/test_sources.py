import json
import pathlib
import random
import re

from pyspark.sql import functions as F

from catalog import citations, queries
from citelake import schemas
from citelake.sinks import documents
from citelake.sources import articles as A, files
from citelake.sources.vocabulary import read_descriptors
from tests import samples as S


def read(spark, folder):
    return A.split_malformed(A.read_articles(spark, folder))


def test_xml_fields(spark, put, tmp_path):
    put("in/a.xml", S.article_set(S.FULL, S.SINGLE, S.BARE))
    good, bad = read(spark, str(tmp_path / "in"))
    rows = {r.doc_id: r for r in good.collect()}
    assert sorted(rows) == ["a_0", "a_1", "a_2"] and bad.isEmpty()
    full = rows["a_0"]
    assert full.pmid == "101"
    assert full.title == "A b c < d & e"
    assert full.journal.volume == "012" and full.journal.pub_month == "Jul"
    kim, lee = full.authors
    assert (kim.last_name, kim.suffix, kim.identifier_source, kim.identifier) == (
        "Kim", "Jr", "ORCID", "0000-1")
    assert [f.affiliation for f in kim.affiliations] == [
        "Univ X Hospital, Norland", "Univ X, H2O Dept, Sudland"]
    assert lee.affiliations == [] and lee.valid_yn == "N"
    assert [(d.pub_status, d.year, d.month) for d in full.pub_dates] == [
        ("received", "2012", "1"), ("pubmed", "2013", "5"), ("pubmed", "2014", "Jul")]
    assert [q.name for q in full.headings[0].qualifiers] == ["surgery", "anatomy"]
    assert full.headings[1].qualifiers == []
    assert full.databanks.complete_yn == "Y"
    assert [(b.name, b.accession_numbers) for b in full.databanks.banks] == [
        ("GENBANK", ["AF1", "AF2"]), ("EMPTY", [])]
    assert [(i.id_type, i.value) for i in full.references[0].article_ids][:2] == [
        ("DOI", "10.1/a"), ("doi", "10.1/b")]
    single = rows["a_1"]
    assert len(single.authors) == len(single.keywords) == len(single.references) == 1
    assert single.keywords[0].keyword == "gamma"
    bare = rows["a_2"]
    assert bare.pmid == "103" and bare.authors == [] and bare.title is None


def test_gzip_equals_plain_and_malformed_is_set_aside(spark, put, tmp_path):
    text = S.article_set(S.FULL, S.BROKEN, S.SINGLE)
    put("in/sub/a.xml", text)
    put("in/b.xml.gz", text)
    put("in/ignored.txt", text)
    good, bad = read(spark, str(tmp_path / "in"))
    rows = good.drop("source_file").collect()
    by_file = {
        f: [r[1:] for r in sorted(rows, key=lambda r: r.doc_id) if r.doc_id.startswith(f)]
        for f in "ab"
    }
    assert by_file["a"] == by_file["b"] and len(by_file["a"]) == 2
    assert sorted(r.doc_id for r in rows) == ["a_0", "a_2", "b_0", "b_2"]
    assert sorted((r.doc_id, r.stage, r.reason) for r in bad.collect()) == [
        ("a_1", "parse", "malformed"), ("b_1", "parse", "malformed")]


def test_ids_follow_the_file_when_it_is_split(spark, put, tmp_path):
    articles = [S.BARE.replace("103", str(1000 + i)) for i in range(500)]
    put("in/big.xml", S.article_set(*articles))
    put("in/small.xml", S.article_set(*articles[:3]))
    default = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        df = A.read_articles(spark, str(tmp_path / "in"))
        records = A.read_records(spark, str(tmp_path / "in"))
        assert records.where("block > 0").count() > 0
        rows = df.select("doc_id", "pmid").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", default)
    assert len(rows) == 503
    assert all(int(r.pmid) == 1000 + int(r.doc_id.split("_")[1]) for r in rows)
    assert len({r.doc_id for r in rows}) == 503


def test_row_tag_reader_gives_the_same_articles(spark, put, tmp_path):
    put("in/a.xml", S.article_set(S.FULL.replace("c &lt; d", "c d"), S.SINGLE, S.BARE))
    path = str(tmp_path / "in")
    split = A.read_articles(spark, path)
    tagged = A.read_articles_by_row_tag(spark, path)
    assert split.columns == tagged.columns
    key = lambda r: r.doc_id
    assert sorted(split.collect(), key=key) == sorted(tagged.collect(), key=key)


def test_record_trees(spark, put, tmp_path):
    put("in/a.xml", S.article_set(S.FULL, S.BROKEN))
    records = A.with_doc_ids(A.read_records(spark, str(tmp_path / "in")))
    trees = {r.doc_id: r.json for r in A.record_trees(records).collect()}
    assert trees["a_1"] is None
    citation = json.loads(trees["a_0"])["MedlineCitation"]
    assert citation["Status"] == "MEDLINE"
    assert citation["PMID"] == {"Version": "1", "value": "101"}
    article = citation["Article"]
    assert article["ArticleTitle"]["value"] == "A b c < d & e"
    authors = article["AuthorList"]["Author"]
    assert isinstance(authors, list) and "value" not in authors[0]
    assert isinstance(authors[0]["AffiliationInfo"], list)
    assert authors[1] == {"ValidYN": "N", "LastName": {"value": "Lee"}}
    assert citation["KeywordList"]["Keyword"][1] == {"MajorTopicYN": "Y", "value": "beta"}


def test_json_files_give_the_same_articles_as_xml(spark, put, tmp_path):
    put("in/a.xml", S.article_set(S.FULL, S.SINGLE, S.BARE))
    records = A.with_doc_ids(A.read_records(spark, str(tmp_path / "in")))
    for row in A.record_trees(records).collect():
        put(f"json/x/{row.doc_id}.json", row.json)
    put("json/bad.json", "{bad")
    trees = A.read_article_json(spark, str(tmp_path / "json"), layout="files")
    good, bad = A.split_unreadable(trees)
    xml = A.split_malformed(A.read_articles(spark, str(tmp_path / "in")))[0]
    order = lambda df: sorted(df.drop("source_file").collect(), key=lambda r: r.doc_id)
    assert order(A.articles_from_trees(good)) == order(xml)
    assert [(r.doc_id, r.reason) for r in bad.collect()] == [("bad", "unreadable json")]
    kept = A.articles_from_trees(good, keep_tree=True)
    assert kept.where(F.expr("variant_get(tree, '$.MedlineCitation.Status', 'string') = 'MEDLINE'")).count() == 1


def test_missing_and_null_nodes(spark, put, tmp_path):
    tree = {"MedlineCitation": {"PMID": {"value": 7}, "Article": {"AuthorList": {"Author": [
        {"AffiliationInfo": {"Affiliation": {}}}, {"AffiliationInfo": {}}, {"AffiliationInfo": None}, {}]}}}}
    put("json/t.json", json.dumps(tree))
    df = A.articles_from_trees(A.read_article_json(spark, str(tmp_path / "json"), layout="files"))
    row = df.first()
    assert row.pmid == "7" and row.keywords == [] and row.databanks.banks == []
    assert [[f.affiliation for f in a.affiliations] for a in row.authors] == [[""], [None], [], []]


def test_descriptors(spark, put, tmp_path):
    put("in/desc.xml", S.MESH)
    rows = {r.descriptor_ui: r for r in read_descriptors(spark, str(tmp_path / "in")).collect()}
    assert rows["D000001"].descriptor_name == "Calcimycin"
    assert rows["D000001"].tree_numbers == ["D03.633", "C01.2", "D04"]
    assert rows["D000002"].tree_numbers == []


def test_positions_do_not_move_the_records(spark, put, tmp_path, monkeypatch):
    """Many splits of a file, automatic broadcast off: no record is shuffled; beyond the bound the numbers are the same."""
    one = "<PubmedArticle><MedlineCitation><PMID>{}</PMID></MedlineCitation></PubmedArticle>\n"
    for name in "ab":
        put(f"in/{name}.xml", S.article_set(*[one.format(i) + " " * (i % 50) for i in range(3000)]))
    settings = {"spark.sql.files.maxPartitionBytes": "20000", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    old = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        records = A.read_records(spark, str(tmp_path / "in"))
        assert records.select("source_file", "block").distinct().count() > 10
        got = A.with_doc_ids(records)
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert "Exchange hashpartitioning" not in plan and "BroadcastHashJoin" in plan
        want = {(f"{name}_{i}", str(i)) for name in "ab" for i in range(3000)}
        pmid = F.regexp_extract("record", "<PMID>(.*)</PMID>", 1)
        assert {tuple(r) for r in got.select("doc_id", pmid).collect()} == want
        monkeypatch.setattr(A, "BROADCAST_SPLITS", 3)
        assert {tuple(r) for r in A.with_doc_ids(records).select("doc_id", pmid).collect()} == want
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_records_are_cut_at_every_opening_tag_with_or_without_patterns(spark, put):
    """One opening tag before a closing one, none, several, and names that only begin like the tag."""
    texts = [
        "<Rec>a</Rec>", "\n<Rec n='1'>b</Rec>", "<RecSet><Rec>c</Rec>", "<Rec>lost<Rec\t>d</Rec>", "<Record>no</Record><Rec>é</Rec>", "x</Rec>",
        "<Rec><RecName>e</RecName></Rec>", "<Recs>",
    ]
    path = put("r.xml", "".join(texts))
    found = [r.record for r in A.read_records(spark, path, "Rec").orderBy("seq").collect()]
    assert found == [
        "<Rec>a</Rec>", "<Rec n='1'>b</Rec>", "<Rec>c</Rec>", "<Rec>lost", "<Rec\t>d</Rec>", "<Rec>é</Rec>",
        "<Rec><RecName>e</RecName></Rec>",
    ]


def test_inflated_records_of_one_file_are_read_by_many_tasks(spark, put, tmp_path):
    """One gzip file is inflated by one task; what it holds is parsed by several."""
    rng = random.Random(1)
    words = ["".join(rng.choices("abcdefghijklmnop", k=9)) for _ in range(4000)]
    records = "".join(f"<PubmedArticle><PMID>{i}</PMID>{' '.join(rng.choices(words, k=600))}</PubmedArticle>" for i in range(8000))
    put("one.xml.gz", records)
    rows, _ = A.gzip_records(files.read_binary(spark, str(tmp_path)))
    per_task = [len(r) for r in rows.select("seq").rdd.glom().collect()]
    assert sum(per_task) == 8000 and sum(n > 0 for n in per_task) > 1


def test_documents_are_written_from_the_tree_at_hand(spark, tmp_path):
    """``article_json`` and ``enriched_json`` need no parsing of their own text before it is written."""
    both = spark.createDataFrame([("d", '{"a":{"b":["1",null]},"c":{}}')], "doc_id string, json string")
    tree = both.withColumn("article", F.parse_json("json"))
    for name, df in {"text": both, "tree": tree}.items():
        documents.write_documents(df, str(tmp_path / name))
    text, tree = (sorted(r.value for r in spark.read.text(str(tmp_path / n)).collect()) for n in ("text", "tree"))
    assert text == tree
    assert "article" in documents.article_json(spark.createDataFrame([], schemas.ARTICLE)).columns


def test_downloads_have_a_file_a_partition(spark):
    """The rows of the large folder are hashed, inflated and read by many tasks, not by one."""
    path = citations.write_downloads(spark, "/root/testdata/sf0.001")
    large = files.read_checks(spark, path, "*.gz").where("path LIKE '%/large/%'")
    assert large.count() > 1 and large.where("fault IS NOT NULL").isEmpty()
    rows = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet").count()
    assert spark.read.text(f"{path}/large/*.gz").count() == rows


def test_a_text_is_cut_once(spark, put):
    """No filter inferred for the explode cuts every text again."""
    plan = A.read_records(spark, put("r.xml", "<PubmedArticle>a</PubmedArticle>"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("split(") == 1


def test_documents_are_written_compressed_and_read_back(spark, tmp_path):
    rows = spark.range(2000).select(
        F.concat(F.lit("d"), F.col("id").cast("string")).alias("doc_id"),
        F.concat(F.lit('{"MedlineCitation":{"PMID":{"value":"'), F.col("id").cast("string"), F.lit('"}}}')).alias("json"),
    )
    path = str(tmp_path / "docs")
    documents.write_documents(rows, path, per_file=500)
    files_written = [f for f in (tmp_path / "docs").iterdir() if f.name.startswith("part-")]
    assert files_written and all(f.name.endswith(".json.gz") for f in files_written)
    trees, bad = A.split_unreadable(A.read_article_json(spark, path))
    assert bad.count() == 0
    assert {(r.doc_id, r.pmid) for r in A.articles_from_trees(trees).collect()} == {(f"d{i}", str(i)) for i in range(2000)}
    batches = str(tmp_path / "batches")
    documents.write_batches(rows.withColumn("batch", F.lit(1)), batches)
    assert all(f.name.endswith(".json.gz") for f in (tmp_path / "batches" / "batch=1").iterdir() if f.name.startswith("part-"))


def test_citations_of_queries_are_written_compressed(spark, tmp_path):
    lines = spark.range(20).select(
        F.col("id").alias("l_orderkey"), F.lit(1).alias("l_linenumber"), F.lit(2).alias("l_suppkey"), F.lit(3).alias("l_partkey"),
        F.lit("N").alias("l_returnflag"),
    )
    lines.write.parquet(str(tmp_path / "lineitem.parquet"))
    orders = spark.range(20).select(F.col("id").alias("o_orderkey"), F.lit("1-URGENT").alias("o_orderpriority"), F.lit("O").alias("o_orderstatus"))
    orders.write.parquet(str(tmp_path / "orders.parquet"))
    for path, n in (
        (citations.write_line_citations(spark, str(tmp_path)), 20),
        (citations.write_order_citations(spark, str(tmp_path), malformed=True, compressed=True), 20),
    ):
        written = [f.name for f in pathlib.Path(path).iterdir() if f.name.startswith("part-")]
        assert written and all(name.endswith(".txt.gz") for name in written)
        ids = A.with_doc_ids(A.read_records(spark, path, glob=queries.TEXT_FILES)).select("doc_id", "source_file", "record").collect()
        assert len(ids) == len({(r.source_file, r.doc_id) for r in ids}) == n
    articles, bad = A.split_malformed(A.read_articles(spark, path, glob=queries.TEXT_FILES))
    assert (articles.count(), bad.count()) == (18, 2)


def test_records_are_cut_without_a_pattern(monkeypatch):
    rng, pattern = random.Random(3), re.compile(r"(?=<T[\s>])")
    bits = ["<T>", "<T a='1'>", "</T>", "<Tx>", "<T", "x", " ", "\n", "<T\xa0>", "<", "</T", "<T<T>", "é"]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randint(0, 14))) for _ in range(2000)]

    def expected(text):
        for between in text.split("</T>"):
            starts = [m.start() for m in pattern.finditer(between)]
            yield from (between[a:b] + ("</T>" if b is None else "") for a, b in zip(starts, [*starts[1:], None]))

    wanted = [list(expected(t)) for t in texts]
    monkeypatch.setattr(re, "compile", None)
    assert [list(A._cut(iter([t[i : i + 5] for i in range(0, len(t), 5)]), "T")) for t in texts] == wanted
