"""Damaged inputs, odd names and whole documents."""

import gzip
import hashlib
import json
import os
import zlib

import pytest

from citelake.operators import integrity
from citelake.plans import load
from citelake.sinks import tables
from citelake.sources import files
from citelake.sources.registry import read_registry
from citelake.streaming.arrivals import start_arrivals
from tests import samples as S


def rows(spark, out, name):
    return [tuple(r) for r in tables.read_table(spark, str(out), name).collect()]


BIG = os.urandom(1000) * 2200
WHOLE = gzip.compress(BIG)


@pytest.mark.parametrize("data,fault", [
    (WHOLE, False),
    (WHOLE + WHOLE, False),
    (WHOLE + b"\0" * 70_000, False),
    (WHOLE + b"junk behind the last member", False),
    (WHOLE + WHOLE[:-9], True),
    (WHOLE[:-1], True),
    (WHOLE + gzip.compress(b"x")[:-1] + b"\1", True),
    (b"", True),
])
def test_gzip_members_beyond_one_megabyte(data, fault):
    assert (integrity._gzip_fault(data) is not None) == fault
    if not fault:
        assert zlib.decompress(data, wbits=31)[:5] == BIG[:5]


def test_run_ids_are_plain(spark, tmp_path):
    for bad in ("2024/01", "50%25", "", "..", "a b", "_x", "run=1"):
        with pytest.raises(ValueError):
            tables.is_finished(spark, str(tmp_path), bad)
        with pytest.raises(ValueError):
            tables.publish(spark, str(tmp_path), bad, "a")
    assert not os.listdir(tmp_path)


def test_a_broken_registry_stops_the_load(spark, put, tmp_path):
    put("xml/a.xml", S.article_set(S.FULL))
    for n, text in enumerate(('[{"name": "Univ X", ', "[]", "no json")):
        put(f"reg{n}/orgs.json", text)
        out = str(tmp_path / f"out{n}")
        with pytest.raises(Exception):
            load.load_xml(spark, str(tmp_path / "xml"), str(tmp_path / f"reg{n}"), out, "r")
        assert not os.path.exists(f"{out}/_log")


def test_a_lost_end_tag_costs_one_article(spark, put, tmp_path):
    one = [f"<PubmedArticle><MedlineCitation><PMID>{i}</PMID></MedlineCitation></PubmedArticle>" for i in range(1, 6)]
    one[1] = one[1].replace("</PubmedArticle>", "")
    put("in/a.xml", S.article_set(*one))
    good, bad = load.ingest_xml(spark, str(tmp_path / "in"))
    assert sorted((r.doc_id, r.pmid) for r in good.collect()) == [("a_0", "1"), ("a_2", "3"), ("a_3", "4"), ("a_4", "5")]
    assert [r.doc_id for r in bad.collect()] == ["a_1"]


def test_damaged_files_are_never_read(spark, put, tmp_path):
    put("in/a.xml", S.article_set(S.FULL))
    put("in/deep/b.xml.gz", S.article_set(S.SINGLE))
    put("in/cut.xml.gz", gzip.compress(S.article_set(*[S.FULL] * 50).encode())[:150])
    bad = load.convert_xml(spark, str(tmp_path / "in"), str(tmp_path / "json")).collect()
    assert [(r.stage, r.source.rsplit("/", 1)[1]) for r in bad] == [("gunzip", "cut.xml.gz")]
    lines = spark.read.text(str(tmp_path / "json")).collect()
    assert {json.loads(r.value)["doc_id"] for r in lines} == {"a_0", "b_0"}
    put("voc/desc.xml", S.MESH)
    put("voc/cut.xml.gz", gzip.compress(S.MESH.encode() * 50)[:90])
    out = str(tmp_path / "voc-out")
    assert load.load_vocabulary(spark, str(tmp_path / "voc"), out, "v")
    assert len(rows(spark, out, "pub_mesh_trees")) == 3
    assert ("gunzip" in {r[2] for r in rows(spark, out, "quarantine")})


def test_sidecars_belong_to_their_folder(spark, put, tmp_path):
    for folder, content in (("a", b"one"), ("b", b"two"), ("c", b"three")):
        put(f"in/{folder}/f.gz", content)
    put("in/a/f.gz.md5", "MD5=" + hashlib.md5(b"one").hexdigest())
    put("in/c/f.gz.md5", "MD5=" + hashlib.md5(b"other").hexdigest())
    got = load.verify_files(spark, str(tmp_path / "in")).collect()
    assert sorted((r.path.rsplit("/", 2)[1], r.name, r.status) for r in got) == [
        ("a", "f.gz", "ok"), ("b", "f.gz", "no_sidecar"), ("c", "f.gz", "mismatch")]
    named = files.read_sidecars(spark, str(tmp_path / "in")).drop("path")
    assert integrity.verify_md5(files.read_binary(spark, str(tmp_path / "in")), named).count() == 3


def test_arrivals_are_enriched_like_a_batch_load(spark, put, tmp_path):
    """The README's way: gate and all."""
    put("in/a.xml", S.article_set(S.FULL, S.BARE))
    put("in/b.xml.gz", S.article_set(S.SINGLE))
    put("reg/orgs.json", S.REGISTRY)
    stream, batch = str(tmp_path / "stream"), str(tmp_path / "batch")
    handler = load.arrivals_handler(read_registry(spark, str(tmp_path / "reg")), stream)
    start_arrivals(spark, str(tmp_path / "in"), str(tmp_path / "check"), handler).awaitTermination()
    load.load_xml(spark, str(tmp_path / "in"), str(tmp_path / "reg"), batch, "r")
    for name in ("pub_pmid_list", "pub_affiliation", "pub_author"):
        assert sorted(map(str, rows(spark, stream, name))) == sorted(map(str, rows(spark, batch, name)))
        assert rows(spark, stream, name)


AUTHOR = {"LastName": {"value": "Kim"}, "Odd": [1, None, {"x": 1.5}]}


def affiliated(text, **more):
    return {"Affiliation": {"value": text, "lang": "en"}, "Extra": True, **more}


TREES = {
    "one": {"Status": "MEDLINE", "MedlineCitation": {"PMID": {"Version": "1", "value": "7"}, "Article": {
        "Abstract": {"value": "text"}, "AuthorList": {"Author": {**AUTHOR, "AffiliationInfo": affiliated("Univ X, Norland")}}}}},
    "many": {"MedlineCitation": {"Article": {"AuthorList": {"CompleteYN": "Y", "Author": [
        {**AUTHOR, "AffiliationInfo": [affiliated("nowhere"), affiliated("Univ X Hospital, Norland", country_code="old")]},
        AUTHOR, {**AUTHOR, "AffiliationInfo": affiliated("Univ X")}]}}}, "PubmedData": {"History": []}},
}


def with_groups(tree):
    """In a list of authors, each has a group of affiliations."""
    authors = tree["MedlineCitation"]["Article"]["AuthorList"]["Author"]
    if not isinstance(authors, list):
        return tree
    tree = json.loads(json.dumps(tree))
    tree["MedlineCitation"]["Article"]["AuthorList"]["Author"] = [
        {**a, "AffiliationInfo": a.get("AffiliationInfo", {})} if isinstance(a, dict) and "AffiliationInfo" not in a else a
        for a in authors
    ]
    return tree


def test_missing_groups_become_empty_objects(spark, put, tmp_path):
    people = [{"LastName": {"value": "A"}}, {"AffiliationInfo": None}, {"AffiliationInfo": []}, "odd", None,
              {"AffiliationInfo": {"Affiliation": {"value": "Univ X"}}}]
    tree = lambda group: {"MedlineCitation": {"Article": {"AuthorList": {"Author": group}}}}
    given = {"list": tree(people), "bare": tree(people[0]), "none": {"MedlineCitation": {"Article": {}}}}
    put("docs/part.json", "\n".join(json.dumps({"doc_id": k, "article": v}) for k, v in given.items()) + "\n")
    put("reg/orgs.json", S.REGISTRY)
    load.enrich_json(spark, str(tmp_path / "docs"), str(tmp_path / "reg"), str(tmp_path / "out"))
    got = {r["doc_id"]: r["article"] for r in map(json.loads, (x.value for x in spark.read.text(str(tmp_path / "out")).collect()))}
    out = got["list"]["MedlineCitation"]["Article"]["AuthorList"]["Author"]
    assert out[0] == {"LastName": {"value": "A"}, "AffiliationInfo": {}} and out[1:5] == people[1:5]
    assert out[5]["AffiliationInfo"]["institution_name"] == "Univ X"
    assert got["bare"] == given["bare"] and got["none"] == given["none"]


def test_enriched_documents_keep_everything_else(spark, put, tmp_path):
    lines = [json.dumps({"doc_id": k, "article": v}) for k, v in TREES.items()]
    put("docs/part.json", "\n".join(lines) + "\n")
    put("reg/orgs.json", S.REGISTRY)
    load.enrich_json(spark, str(tmp_path / "docs"), str(tmp_path / "reg"), str(tmp_path / "out"), mode="independent")
    got = {}
    for r in spark.read.text(str(tmp_path / "out")).collect():
        line = json.loads(r.value)
        got[line["doc_id"]] = line["article"]
    assert set(got) == {"one", "many"}
    added = {"institution_name", "country_code", "country_name"}

    def strip(tree):
        if isinstance(tree, dict):
            return {k: strip(v) for k, v in tree.items() if k not in added}
        return [strip(v) for v in tree] if isinstance(tree, list) else tree

    for name in got:
        assert strip(got[name]) == strip(with_groups(TREES[name]))
    author = got["one"]["MedlineCitation"]["Article"]["AuthorList"]["Author"]
    assert author["AffiliationInfo"]["institution_name"] == "Univ X"
    first = got["many"]["MedlineCitation"]["Article"]["AuthorList"]["Author"][0]["AffiliationInfo"]
    assert not added & set(first[0]) and first[1]["institution_name"] == "Univ X Hospital"
    assert first[1]["country_code"] != "old"


def test_formulas_read_the_same_on_both_ways(spark, put, tmp_path):
    title = ('Value of <mml:math xmlns:mml="http://www.w3.org/1998/Math/MathML" display="inline"><mml:mi>x</mml:mi>'
             "<mml:mspace/></mml:math> &lt; 3 <i>now</i>")
    put("in/a.xml", S.article_set(f"<PubmedArticle><MedlineCitation><PMID>1</PMID><Article><ArticleTitle>{title}"
                                  "</ArticleTitle></Article></MedlineCitation></PubmedArticle>"))
    typed, _ = load.ingest_xml(spark, str(tmp_path / "in"))
    load.convert_xml(spark, str(tmp_path / "in"), str(tmp_path / "json"))
    trees, _ = load.ingest_json(spark, str(tmp_path / "json"), "lines")
    assert [r.title for r in typed.collect()] == [r.title for r in trees.collect()] == ["Value of x < 3 now"]
