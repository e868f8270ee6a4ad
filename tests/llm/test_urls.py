import math

import numpy as np
from pyspark.sql import functions as F

from citelake.llm.urls import ORDER, RULES, SYMBOLS, Models, contexts, filter_urls, fit, judged
from tests.llm.tables import SF, given

PAGES = "page_id long, url string, html string"


def split(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    end = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
    host, tail = rest[:end], rest[end:]
    cut = min([tail.find(c) for c in "?#" if c in tail] or [len(tail)])
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    return lower, tail[:cut]


def ruled(host, path):
    fits = [(len(d + p), d + p, v) for v, d, p in RULES if (host == d or host.endswith("." + d)) and path.startswith(p)]
    return max(fits)[1:] if fits else (None, None)


def test_given_table(spark):
    rows = {r.page_id: r for r in filter_urls(spark.read.parquet(f"{SF}/pages.parquet")).collect()}
    pages = given("pages")
    assert len(rows) == len(pages)
    for p in pages:
        r, (host, path) = rows[p["page_id"]], split(p["url"])
        rule, verdict = ruled(host, path)
        assert (r.host, r.path, r.rule) == (host, path, rule)
        assert r.verdict == verdict if rule else r.verdict in ("allow", "block")


def made():
    rows = []
    for i in range(600):
        rows.append(f"http://www.{'quiet' if i % 2 else 'garden'}{i % 7}.net/articles/{i}")
        if i % 3 == 0:
            rows.append(f"http://casino-bonus{i % 9}.net/win/{i * 7}")
    rows += ["http://cas-bonus3.net/win/701", "http://garden3.net/articles/7001", "http://m.example.org/es/1"]
    return [(i, u, None) for i, u in enumerate(rows)]


def test_models_tell_urls_apart(spark):
    df = spark.createDataFrame(made(), PAGES)
    got = {r.page_id: r for r in filter_urls(df).collect()}
    n = len(got)
    assert got[n - 3].verdict == "block" and got[n - 2].verdict == "allow" and got[n - 1].rule == "example.org/es/"
    plain = [r for r in got.values() if r.rule is None and "casino" not in r.host]
    assert sum(r.verdict == "block" for r in plain) <= 0.02 * len(plain)
    assert all(r.verdict == "block" for r in got.values() if "casino" in r.host)


def test_counts_cover_every_training_url_and_scores_equal_plain_ones(spark):
    df = spark.createDataFrame(made(), PAGES)
    models = fit(judged(df))
    known = [(split(u)[0] + split(u)[1], "casino" not in u) for _, u, _ in made() if "/es/" not in u]
    assert models.counts[:, 0, 0].sum() == sum(len(u) + 1 for u, _ in known)
    assert models.counts.sum() == (ORDER + 1) * sum(len(u) + 1 for u, _ in known)
    for url in ("garden3.net/articles/7", "x"):
        flat, cells, _ = contexts([url])
        total = 0.0
        for i, c in enumerate(flat):
            p = []
            for counts in models.counts:
                chance = 1 / SYMBOLS
                for order in range(ORDER + 1):
                    row = counts[order, cells[order][i]]
                    if row.sum():
                        kinds = (row > 0).sum()
                        chance = (row[c] + kinds * chance) / (row.sum() + kinds)
                p.append(chance)
            total += math.log(p[1] / p[0])
        assert abs(models.differences([url])[0] - total / len(flat)) < 1e-9


def test_contexts_do_not_cross_urls():
    both, cells, ends = contexts(["abc", "abc"])
    assert list(ends) == [4, 8] and (cells[:, :4] == cells[:, 4:]).all() and (both[:4] == both[4:]).all()
    empty = Models(np.zeros((2, ORDER + 1, 1 << 13, SYMBOLS), dtype=np.int32), 0.0)
    assert empty.differences([]).size == 0 and empty.differences([""]).tolist() == [0.0]


def test_odd_rows(spark):
    rows = [(1, None, None), (2, "", None), (3, "no scheme", None), (None, "http://X.COM/de/?x", None), (5, "a://b" + "c" * 50_000, None), (5, "a://b", None), (5, "a://b", None), (6, "http://É.org/ü\n", None)]
    df = spark.createDataFrame(rows, PAGES).withColumn("host", F.lit(1)).withColumn("difference", F.lit("x"))
    got = filter_urls(df).collect()
    assert len(got) == len(rows)
    assert [(r.host, r.path, r.rule, r.verdict) for r in got if r.page_id is None] == [("x.com", "/de/", "com/de/", "block")]
    assert all((r.host, r.path, r.verdict) == ("", "", "allow") for r in got if r.page_id in (1, 2, 3))
    assert [(r.host, r.path, r.rule) for r in got if r.page_id == 6] == [("É.org", "/ü\n", "org/")]
    assert filter_urls(spark.createDataFrame([], PAGES)).collect() == []


def test_no_two_contexts_share_a_count():
    """More contexts of each order than a table of fixed size could hold apart."""
    signs = "abcdefghijklmnopqrstuvwxyz0123456789"
    urls = [a + b + c + d for a in signs[:12] for b in signs for c in signs for d in signs[-12:]]
    flat, cells, ends = contexts(urls)
    assert len(set(cells[4][ends - 1].tolist())) == len(urls)
    assert len(set(cells[3][ends - 1].tolist())) == len({u[1:] for u in urls})


def test_joined_counts_score_as_broadcast_ones(spark):
    odd = [(9000, None, None), (9001, "a://b/" + "q" * 3000, None), (9002, "http://m.example.org/es/never-seen-before", None)]
    df = spark.createDataFrame(made() + odd, PAGES)
    want = {r.page_id: r for r in filter_urls(df).collect()}
    for head in (1, 60, 1_000_000):
        got = {r.page_id: r for r in filter_urls(df, near=0, head=head).collect()}
        assert got.keys() == want.keys()
        for i, r in want.items():
            assert abs(got[i].difference - r.difference) < 1e-9
            assert got[i].asDict() | {"difference": 0} == r.asDict() | {"difference": 0}
