"""Damaged files on both ways in; names that look like patterns or escapes."""

import gzip
import hashlib
import os
import tracemalloc

import pytest

from citelake.operators import integrity
from citelake.plans import load
from citelake.sinks import tables
from citelake.sources import articles as A, files
from citelake.streaming.arrivals import start_arrivals
from tests import samples as S

ODD_NAMES = ["a b.xml.gz", "p[1].xml.gz", "q%20x.xml.gz", "{z}.xml", "s*t.xml", "u?.xml.gz", "é.xml"]


def pmid(n):
    return S.FULL.replace(">101<", f">{n}<")


def record(n):
    return f"<PubmedArticle><MedlineCitation><PMID>{n}</PMID></MedlineCitation></PubmedArticle>"


@pytest.fixture
def odd(put, tmp_path):
    for n, name in enumerate(ODD_NAMES):
        put(f"in/{name}", S.article_set(record(1000 + n)))
    whole = gzip.compress(S.article_set(*[record(i) for i in range(5000)]).encode())
    put("in/cut.xml.gz", whole[: len(whole) // 2])
    put("in/none.xml.gz", b"no gzip at all")
    return str(tmp_path / "in")


def test_any_name_beside_damaged_files(spark, odd):
    articles, bad = load.ingest_xml(spark, odd)
    assert sorted(r.pmid for r in articles.collect()) == [str(1000 + n) for n in range(len(ODD_NAMES))]
    rows = {os.path.basename(r.source): (r.stage, r.reason) for r in bad.collect()}
    assert rows["cut.xml.gz"] == ("gunzip", "unexpected end of file") and rows["none.xml.gz"][0] == "gunzip" and len(rows) == 2


@pytest.mark.parametrize("max_files", [5, 1000])
def test_stream_equals_the_batch_load(spark, odd, put, tmp_path, max_files):
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "check")

    def handle(articles, quarantine, run_id):
        load.store(articles, out, run_id, gate="none", quarantine=quarantine)

    def run():
        start_arrivals(spark, odd, checkpoint, handle, max_files=max_files).awaitTermination()
        stored = sorted(r[0] for r in tables.read_table(spark, out, "pub_pmid_list").collect())
        return stored, sorted((os.path.basename(r.source), r.stage) for r in tables.read_table(spark, out, "quarantine").collect())

    usual = [1000 + n for n in range(len(ODD_NAMES))]
    assert run() == (usual, [("cut.xml.gz", "gunzip"), ("none.xml.gz", "gunzip")])
    put("in/later.xml.gz", S.article_set(record(7), S.BROKEN))
    stored, bad = run()
    assert stored == [7, *usual] and ("later.xml.gz", "parse") in bad and len(bad) == 3


def test_enriching_stream_goes_on_after_damage(spark, put, tmp_path):
    put("reg/orgs.json", S.REGISTRY)
    put("in/a.xml.gz", S.article_set(S.FULL))
    put("in/b.xml.gz", gzip.compress(S.article_set(S.FULL).encode())[:-9])
    out = str(tmp_path / "out")
    handle = load.arrivals_handler(load.registries.read_registry(spark, str(tmp_path / "reg")), out)
    start_arrivals(spark, str(tmp_path / "in"), str(tmp_path / "check"), handle).awaitTermination()
    totals = {r.outcome: r.n for r in tables.load_totals(spark, out).collect()}
    assert totals == {"stored": 1, "unmatched": 0, "gunzip": 1}


def test_gzip_records_equal_the_text_source(spark, put, tmp_path):
    """Lost end tags, text before and after, members, positions over many pieces."""
    body = [record(i) + "x" * (i % 900) for i in range(4000)]
    body[5] = body[5].replace("</PubmedArticle>", "")
    body[-1] = body[-1].replace("</PubmedArticle>", "")
    text = S.article_set(*body).encode()
    put("in/a.xml.gz", gzip.compress(text[:70_001]) + gzip.compress(text[70_001:]))
    put("in/empty.xml.gz", gzip.compress(b""))
    key = lambda df: sorted((r.doc_id, r.record) for r in A.with_doc_ids(df).collect())
    records, bad = A.gzip_records(files.read_binary(spark, str(tmp_path / "in")))
    assert bad.isEmpty()
    want = key(A.read_records(spark, str(tmp_path / "in")))
    assert key(records) == want and len(want) == 4000


def test_inflated_in_pieces():
    data = gzip.compress(os.urandom(3 << 20)) + gzip.compress(b"tail")
    pieces = list(integrity.inflated(integrity.sliced(data)))
    assert max(map(len, pieces)) <= 1 << 20 and len(b"".join(pieces)) == (3 << 20) + 4
    assert list(integrity.inflated(integrity.sliced(data[:-9])))[-1] == "unexpected end of file"


@pytest.mark.parametrize("step", [1, 2, 7, 1000])
def test_pieces_of_any_size_give_the_same(step):
    """Members, their borders and what follows them, cut anywhere."""
    one, two = gzip.compress(b"first " * 50), gzip.compress(b"second")
    cut = lambda data: [data[i : i + step] for i in range(0, len(data), step)]
    for data, fault in [(one + two, None), (one + b"\0" * 9, None), (one + b"\x1f", None), (one + two[:-1], "unexpected end of file"), (b"", "unexpected end of file")]:
        assert integrity.gzip_fault(cut(data)) == fault
    assert b"".join(p for p in integrity.inflated(cut(one + two))) == b"first " * 50 + b"second"
    assert integrity.gzip_fault(cut(b"no gzip")) is not None


def test_files_of_no_bytes_and_large_ones(spark, put, tmp_path):
    """Hashed and inflated in pieces, in a process that may not hold the file."""
    big = os.urandom(1 << 20) * 64
    put("in/big.xml.gz", gzip.compress(big, 1) + gzip.compress(bytes(256 << 20), 1))
    put("in/none.xml.gz", b"")
    put("in/deep/a b.xml.gz", gzip.compress(b"x"))
    for name in ("big", "none", "deep/a b"):
        data = (tmp_path / f"in/{name}.xml.gz").read_bytes()
        put(f"in/{name}.xml.gz.md5", f"MD5(x)= {hashlib.md5(data).hexdigest()}\n")
    put("in/none.xml.gz.md5", "MD5(x)= 0\n")
    found = {r.name: r for r in files.read_checks(spark, str(tmp_path / "in"), "*.gz").collect()}
    assert {n: (r.length, r.fault) for n, r in found.items() if n != "big.xml.gz"} == {
        "none.xml.gz": (0, "unexpected end of file"), "a b.xml.gz": (21, None)}
    assert found["big.xml.gz"].fault is None and found["big.xml.gz"].length > 1 << 20
    statuses = {r.name: r.status for r in load.verify_files(spark, str(tmp_path / "in")).collect()}
    assert statuses == {"big.xml.gz": "ok", "a b.xml.gz": "ok", "none.xml.gz": "mismatch"}


def test_reading_in_pieces_holds_one_piece(tmp_path):
    """Peak of what Python allocates, for a file of 200 MB of zeros inflated."""
    path = tmp_path / "zeros.gz"
    with gzip.open(path, "wb", 1) as out:
        for _ in range(200):
            out.write(bytes(1 << 20))
    tracemalloc.start()
    (row,) = files.CheckReader({"path": str(tmp_path), "glob": "*.gz"}).read(files.FilePartition(str(path), 0))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert row[4] is None and peak < 16 << 20
