import gzip
import hashlib

import pytest
from pyspark.sql import functions as F

from citelake import schemas
from citelake.functions import text as X, trees
from citelake.operators import dictionary as D
from citelake.operators import enrich as E
from citelake.operators import flatten, gates, integrity, keys, vocabulary
from citelake.sources import articles as A
from citelake.sources import files, registry
from citelake.sources.vocabulary import read_descriptors
from tests import samples as S

GRAMS = {"in_row_names": 0}


def article(doc_id="d", authors=(), dates=(), **more):
    def aff(f):
        return f if isinstance(f, tuple) else (f, None, None, None)

    row = {
        "doc_id": doc_id, "source_file": "s", "pmid": "1", "title": None, "journal": None,
        "authors": [(None, n, None, None, None, None, None, [aff(f) for f in fs]) for n, fs in authors],
        "pub_dates": list(dates), "headings": [], "references": [], "databanks": None, "keywords": [],
    }
    row.update(more)
    return tuple(row.values())


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), schemas.ARTICLE)


def test_scalar_rules(spark):
    values = ["12", " 12\t", "12.7", "Jul", "", None, "99999999999", "5d", "-3", "1e2", "0x1", ".5", "007"]
    df = spark.createDataFrame([(v,) for v in values], "v string")
    got = [r[0] for r in df.select(X.to_int(F.col("v"))).collect()]
    assert got == [12, 12, 12, 0, 0, 0, 0, 0, -3, 100, 0, 0, 7]
    trimmed = spark.createDataFrame([("\t a b \n\x01",), (None,)], "v string").select(X.jtrim(F.col("v")))
    assert [r[0] for r in trimmed.collect()] == ["a b", None]
    blank = spark.createDataFrame([("\t \n",), ("x ",), (None,), ("",)], "v string")
    assert [r[0] for r in blank.select(X.nonblank(F.col("v"))).collect()] == [False, True, False, False]


def registry_rows(spark, put, tmp_path, **kw):
    return registry.read_registry(spark, put("reg/orgs.json", S.REGISTRY), **kw)


def test_dictionaries(spark, put, tmp_path):
    entries = registry_rows(spark, put, tmp_path)
    orgs = {r.name: (r.country_code, r.country_name) for r in D.organisation_dictionary(entries).collect()}
    assert orgs == {"Univ X": ("NO", "Norland"), "Univ X Hospital": ("SU", "Sudland"),
                    "Dup": ("XX", "Sudland"), "Stateless Lab": ("", "")}
    countries = {r.country_name: r.country_code for r in D.country_dictionary(entries).collect()}
    assert countries == {"Norland": "NO", "Sudland": "XX", "Nameless": "QQ"}


def test_curate_keeps_all_fields(spark, put, tmp_path):
    sheet = put("sheet.csv", 'MP,NO,"Name1"\ndelete,1,UNIV X\n Delete ,2, Dup \nKeep,3,Univ X Hospital\nDelete,4,\n,5,Stateless Lab\nDelete,6,"A ""b""\nc",more\n')
    entries = registry_rows(spark, put, tmp_path, whole=True)
    rows = registry.read_review_sheet(spark, sheet)
    assert rows.where(F.col("name") == 'A "b"\nc').count() == 1
    left = D.curate(entries, rows)
    assert sorted(r.id for r in left.collect()) == ["r2", "r5", "r6"]
    assert "country" in left.columns


def indexes(spark, **limits):
    orgs = spark.createDataFrame(
        [("Univ X", "NO", "Norland"), ("Univ X Hospital", "SU", "Sudland"), ("Blank Lab", "", "")],
        "name string, country_code string, country_name string")
    countries = spark.createDataFrame(
        [("Norland", "NO"), ("Sudland", "SU")], "country_name string, country_code string")
    return E.organisation_index(orgs, **limits), E.country_index(countries, **limits)


def enriched(spark, mode, limits, **kw):
    rows = frame(
        spark,
        article("both", [("a", ["Univ X Hospital, Norland", "Univ X, Norland"]), ("b", [])]),
        article("country", [("a", ["Somewhere, Sudland"]), ("b", ["null", "", None])]),
        article("blank", [("a", ["Blank Lab, Norland"])]),
        article("none", [("a", [("nowhere", "old", "OC", "Old")])]),
        article("split", [("a", ["Univ X"]), ("b", ["in Sudland"])]),
    )
    df = E.enrich(rows, *indexes(spark, **limits), mode, **kw)
    assert df.schema.simpleString() == rows.schema.simpleString()
    return {
        r.doc_id: [[tuple(f[1:]) for f in a.affiliations] for a in r.authors] for r in df.collect()
    }


@pytest.mark.parametrize("limits", [{}, GRAMS])
def test_enrich_fallback(spark, limits):
    none = (None, None, None)
    assert enriched(spark, "fallback", limits) == {
        "both": [[("Univ X Hospital", "SU", "Sudland"), ("Univ X", "NO", "Norland")], []],
        "country": [[(None, "SU", "Sudland")], [none, none, none]],
        # An organisation without a country still wins over the country match.
        "blank": [[("Blank Lab", "", "")]],
        "none": [[("old", "OC", "Old")]],
        "split": [[("Univ X", "NO", "Norland")], [(None, "SU", "Sudland")]],
    }


@pytest.mark.parametrize("limits", [{}, GRAMS])
def test_enrich_independent_keeps_only_full_matches(spark, limits):
    assert enriched(spark, "independent", limits) == {
        "both": [[("Univ X Hospital", "NO", "Norland"), ("Univ X", "NO", "Norland")], []],
        "blank": [[("Blank Lab", "NO", "Norland")]],
        "split": [[("Univ X", None, None)], [(None, "SU", "Sudland")]],
    }
    assert len(enriched(spark, "independent", limits, require_both=False)) == 5


def test_gates(spark):
    rows = frame(
        spark,
        article("ok", [("a", [("t", "I", "C", "N")])]),
        article("two_authors", [("a", [("t", "I", " ", None)]), ("b", [("t", None, "C", None)])]),
        article("no_text", [("a", [(None, "I", "C", "N")])]),
        article("blank", [("a", [("t", "\t", "C", "N")])]),
        article("empty", []),
    )
    names = lambda df: sorted(r.doc_id for r in df.collect())
    assert names(gates.gate_any(rows)) == ["no_text", "ok", "two_authors"]
    assert names(gates.gate_with_affiliation(rows)) == ["ok", "two_authors"]
    dated = frame(
        spark,
        article("y13", dates=[("pubmed", "2013", "1", "1")]),
        article("y14", dates=[("received", "2010", "1", "1"), ("pubmed", "2014", "Jul", "2")]),
        article("other", dates=[("received", "2020", "1", "1")]),
        article("none"),
    )
    assert names(gates.gate_year(dated)) == ["y14"]
    assert names(gates.gate_year(dated, 2013)) == ["y13", "y14"]


def test_dense_numbers(spark):
    df = spark.range(5000).select(F.concat(F.lit("k"), "id").alias("k")).repartition(7)
    rows = keys.dense_numbers(df, ["k"], "n", start=11).collect()
    order = sorted(rows, key=lambda r: (hashlib.md5(r.k.encode()).hexdigest()[:3], r.k))
    assert [r.n for r in order] == list(range(11, 5011))
    again = {r.k: r.n for r in keys.dense_numbers(df.repartition(3), ["k"], "n", start=11).collect()}
    assert again == {r.k: r.n for r in rows}
    batches = keys.batch_numbers(df, ["k"], size=1500).groupBy("batch").count().collect()
    assert sorted((r.batch, r["count"]) for r in batches) == [(1, 1500), (2, 1500), (3, 1500), (4, 500)]


@pytest.fixture
def stored(spark, put, tmp_path):
    put("in/a.xml", S.article_set(S.FULL, S.SINGLE, S.BARE))
    good, _ = A.split_malformed(A.read_articles(spark, str(tmp_path / "in")))
    return keys.number_articles(good, {"author": 100})


def test_tables(spark, stored):
    result = flatten.flatten_articles(stored)
    for name, df in result.items():
        want = spark.createDataFrame([], schemas.TABLE_COLUMNS[name]).schema.simpleString()
        assert df.schema.simpleString() == want, name
    rows = {n: [tuple(r) for r in df.collect()] for n, df in result.items()}
    assert sorted(rows["pub_pmid_list"]) == [(101,), (102,), (103,)]
    assert sorted(rows["pub_pubdate"]) == [(101, 2013, 5, 6), (102, 2016, 2, 3)]
    recent = flatten.pubdate(stored, 2014).collect()
    assert sorted(map(tuple, recent)) == [(101, 2014, 0, 8), (102, 2016, 2, 3)]
    assert sorted(rows["pub_article_title"]) == [
        (101, "A b c < d & e"), (102, "One of each"), (103, "")]
    assert (103, "", "", "", "", 0, "", 0) in rows["pub_journal"]
    assert (101, "Journal of Tests", "J Tests", "012", "3", 2015, "Jul", 7) in rows["pub_journal"]
    assert sorted(r[1] for r in rows["pub_author"]) == [100, 101, 102]
    assert {(r[3], r[2], r[5], r[7], r[8], r[9]) for r in rows["pub_author"]} == {
        ("Kim", "Y", None, "Jr", "ORCID", "0000-1"), ("Lee", "N", None, "", "", ""),
        ("Solo", "Y", None, "", "", "")}
    assert sorted(r[1] for r in rows["pub_affiliation"]) == [1, 2, 3]
    assert {(r[2], r[5], r[6]) for r in rows["pub_affiliation"]} == {
        ("Univ X Hospital, Norland", "ORCID", "0000-1"),
        ("Univ X, H2O Dept, Sudland", "ORCID", "0000-1"), ("Univ X, Norland", "", "")}
    # Links find both parents, and the right ones.
    names = {r[1]: r[3] for r in rows["pub_author"]}
    texts = {r[1]: r[2] for r in rows["pub_affiliation"]}
    assert {(names[a], texts[f]) for _, a, f in rows["pub_author_affiliation"]} == {
        ("Kim", "Univ X Hospital, Norland"), ("Kim", "Univ X, H2O Dept, Sudland"),
        ("Solo", "Univ X, Norland")}
    heads = {(r[2], r[3], r[4], r[5], r[6], r[7], r[8]) for r in rows["pub_mesh_heading"]}
    assert heads == {
        ("Heart", "N", None, "D1", "surgery", "Y", "Q1"),
        ("Heart", "N", None, "D1", "anatomy", "N", "Q2"),
        ("Lung", "Y", None, "D2", None, None, None),
        ("Eye", "N", None, "D3", "injuries", "N", "Q3")}
    assert len({r[1] for r in rows["pub_mesh_heading"]}) == 3
    assert {r[2:] for r in rows["pub_reference"]} == {
        ("First ref", "55", "10.1/b", None, None), ("Second ref", None, None, None, None),
        ("Only ref", None, None, None, "S1")}
    assert sorted(rows["pub_databank_list"]) == [
        (101, "Y", "GENBANK", "AF1"), (101, "Y", "GENBANK", "AF2"), (102, "N", "PDB", "1ABC")]
    assert sorted(r[0] for r in rows["pub_keyword_list"]) == [1, 2, 3]
    assert {r[1:] for r in rows["pub_keyword_list"]} == {
        (101, "alpha", "N"), (101, "beta", "Y"), (102, "gamma", "N")}


def test_staged_numbers_are_the_same_and_flatteners_do_not_shuffle(spark, stored):
    articles = stored.drop(*[f"{k}_base" for k in keys.ARTICLE_KEYS])
    staged = keys.number_articles(articles, {"author": 100}, staged=True)
    assert sorted(map(str, staged.collect())) == sorted(map(str, stored.collect()))
    for name, df in flatten.flatten_articles(staged).items():
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert plan.replace("BroadcastExchange", "").count("Exchange") == 0, name


def test_vocabulary(spark, put, tmp_path):
    put("in/desc.xml", S.MESH)
    result = vocabulary.flatten_descriptors(read_descriptors(spark, str(tmp_path / "in")))
    assert sorted(map(tuple, result["pub_mesh_desc_list"].collect())) == [
        ("D000001", "Calcimycin"), ("D000002", "Treeless")]
    assert sorted(map(tuple, result["pub_mesh_trees"].collect())) == [
        ("D000001", "C01.2", "C"), ("D000001", "D03.633", "D"), ("D000001", "D04", "D")]


def test_md5(spark, put, tmp_path):
    digest = hashlib.md5(b"data").hexdigest()
    cases = {
        "eq": (f"MD5(eq.gz)= {digest.upper()}\n", "ok"),
        "sum": (f"{digest}  sum.gz\n", "ok"),
        "wrong": (f"{'0' * 32}  wrong.gz", "mismatch"),
        "bare": (digest, "bad_format"),
        "odd": ("not a checksum", "bad_format"),
        "noval": ("MD5(x) =", "bad_format"),
        "lines": (f"{digest} a\nb", "bad_format"),
        "none": (None, "no_sidecar"),
    }
    for name, (sidecar, _) in cases.items():
        put(f"in/{name}.gz", b"data")
        if sidecar is not None:
            put(f"in/{name}.gz.md5", sidecar)
    path = str(tmp_path / "in")
    got = integrity.verify_md5(files.read_binary(spark, path), files.read_sidecars(spark, path))
    assert {r.name: r.status for r in got.collect()} == {f"{n}.gz": s for n, (_, s) in cases.items()}
    failed = {(r.source.rsplit("/", 1)[1], r.stage, r.reason) for r in integrity.failed_files(got).collect()}
    assert len(failed) == 6 and ("none.gz", "checksum", "no_sidecar") in failed
    remote = spark.createDataFrame([("eq.gz",), ("wrong.gz",), ("new.gz",), ("x.txt",)], "name string")
    todo = files.new_files(remote, integrity.verified(got))
    assert sorted(r.name for r in todo.collect()) == ["new.gz", "wrong.gz"]


def test_gzip(spark, put, tmp_path):
    whole = gzip.compress(b"some text " * 100_000)
    flipped = bytearray(whole)
    flipped[-6] ^= 1
    cases = {
        "whole": whole, "members": whole + gzip.compress(b"more"), "trailing": whole + b"\0junk",
        "empty_member": gzip.compress(b""), "cut": whole[:150], "cut_tail": whole[:-3],
        "crc": bytes(flipped), "plain": b"not gzip",
        "second_cut": whole + whole[:60],
    }
    for name, data in cases.items():
        put(f"in/{name}.gz", data)
    got = integrity.check_gzip(files.read_binary(spark, str(tmp_path / "in"))).collect()
    good = {"whole.gz", "members.gz", "trailing.gz", "empty_member.gz"}
    assert {r.name for r in got if r.ok} == good and len(got) == len(cases)
    assert all((r.reason is None) == r.ok for r in got)


def test_hot_keys(spark):
    """A third of all rows under one name, one text or one file."""
    entries = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("n"), "id")).alias("name"),
        F.col("id").cast("string").alias("v"), F.col("id").alias("pos"))
    best = D.last_wins(entries, "name", "pos", ["v"])
    assert best.count() == 20_001 and best.where("name = 'hot'").first().v == "29997"
    names = spark.range(500).select(F.concat(F.lit("Institute No "), "id").alias("name"))
    from citelake.operators import matching

    index = matching.build_index(names)
    texts = spark.range(6_000).select("id", F.when(F.col("id") % 3 == 0, "at Institute No 7, X").otherwise(
        F.concat(F.lit("Institute No "), F.col("id") % 700)).alias("text"))
    hits = matching.best_hits(texts, ["id"], "text", index)
    assert hits.where("name = 'Institute No 7'").count() >= 2_000
    # Every 700..: only shorter names may match there.
    want = texts.where("id % 3 = 0 or id % 700 < 500").count()
    assert hits.where("id % 3 = 0 or id % 700 < 500").count() == want


def test_different_numbers(spark):
    """As a set would count them, over bucket borders, with repeats and nulls."""
    values = [1, 1, 32768, 32769, 65536, 10**12, 10**12, None]
    df = spark.createDataFrame([(v,) for v in values], "n bigint").repartition(3)
    assert keys.different_numbers(df, "n").collect()[0].numbers == 5
    assert keys.different_numbers(df.where("n < 0"), "n").collect()[0].numbers == 0
    plan = keys.different_numbers(df, "n")._jdf.queryExecution().executedPlan().toString()
    assert "keys=[n#" not in plan  # no set of the numbers themselves


def test_gzip_check_takes_small_batches(spark):
    spark.conf.unset("spark.sql.execution.arrow.maxBytesPerBatch")
    rows = [(str(i), str(i), gzip.compress(b"x" * i)[: None if i % 2 else -5]) for i in range(20)]
    checked = integrity.check_gzip(spark.createDataFrame(rows, "name string, path string, content binary"))
    assert int(spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch")) <= 8 << 20
    assert {r.name: r.ok for r in checked.collect()} == {str(i): i % 2 == 1 for i in range(20)}


def test_changed_trees_are_worked_out_once(spark):
    texts = ['{"a":{"b":1},"x":null}', '{"a":{"x":{"y":2}}}', "[1]", "null", None, "{}"]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").select("i", F.parse_json("t").alias("v"))
    new = trees.changed(F.col("v"), "a", lambda a: trees.changed(trees.with_member(a, "x"), "x", lambda x: trees.with_texts(x, {"z": F.lit("n")})))
    got = {r.i: r.j for r in rows.select("i", F.to_json(new).alias("j")).collect()}
    assert got == {0: '{"a":{"b":1,"x":{"z":"n"}},"x":null}', 1: '{"a":{"x":{"y":2,"z":"n"}}}', 2: "[1]", 3: "null", 4: None, 5: "{}"}
    # However often the changed member is used, it is made once.
    plan = rows.select(new.alias("n"))._jdf.queryExecution().analyzed().toString()
    assert plan.count("map_concat(") + plan.count("mapconcat(") == 2


def test_numbering_carries_only_what_is_kept(spark):
    rows = [
        article(f"d{i}", [("a", ["x"] * (i % 3))], keywords=[("k", "Y")] * (i % 4), references=[("cited", [])] * (i % 2))
        for i in range(40)
    ]
    articles = frame(spark, *rows)
    whole = keys.number_articles(articles, {"author": 100})
    few = keys.number_articles(keys.counted(articles), {"author": 100}, kept=["pmid", "authors"])
    bases = [f"{x}_base" for x in keys.ARTICLE_KEYS]
    assert few.columns == ["doc_id", "source_file", "pmid", "authors", *bases]
    assert sorted(few.select("doc_id", *bases).collect()) == sorted(whole.select("doc_id", *bases).collect())
    staged = keys.number_articles(keys.counted(articles), staged=True, kept=["pmid", "authors"])
    assert staged.columns == few.columns and staged.count() == 40
    # Beside the whole articles nothing of the counting is left.
    assert keys.number_articles(keys.counted(articles)).columns == whole.columns


def test_dealt_articles_are_shuffled_once_in_any_session(spark):
    key = "spark.sql.requireAllClusterKeysForCoPartition"
    held = {k: spark.conf.get(k) for k in (key, "spark.sql.autoBroadcastJoinThreshold")}
    rows = [article(f"d{i}", [("a", [f"Dept, Institute {i}"])]) for i in range(40)]
    names = spark.range(40).select(F.concat(F.lit("Institute "), "id").alias("name"), F.lit("C").alias("country_code"), F.lit("Land").alias("country_name"))
    countries = E.country_index(spark.createDataFrame([("Land", "C")], "country_name string, country_code string"))
    try:
        spark.conf.set(key, "true")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
        index = E.organisation_index(names, **GRAMS)
        # As in the catalog's queries, the file is the same for all articles, and known before they are read.
        articles = frame(spark, *rows).withColumn("source_file", F.lit("s"))
        enriched = E.enrich(articles, index, countries, bucketed=True)
        plan = enriched._jdf.queryExecution().executedPlan().toString()
        # Articles by bucket and hits by bucket.
        assert plan.count("Exchange hashpartitioning") == 2, plan
        assert enriched.where("authors[0].affiliations[0].institution_name IS NOT NULL").count() == 40
    finally:
        for k, v in held.items():
            spark.conf.set(k, v)
