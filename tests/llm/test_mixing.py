import collections

from citelake.llm.mixing import mix, mixed_documents
from tests.llm.tables import ODD_ROWS, SF, WORD, close, documents, given, widened


def levels(sizes, weights=(5, 2, 1), share=1.5, most=2.0):
    """Targets by resharing the excess again and again."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    budget, out, free = share * sum(sizes.values()), {}, set(order)
    while free:
        total = sum(weight[s] for s in free)
        over = [s for s in free if budget * weight[s] / total >= most * sizes[s]]
        if not over:
            out |= {s: budget * weight[s] / total for s in free}
            break
        for s in over:
            out[s] = most * sizes[s]
            free.discard(s)
        budget -= sum(out[s] for s in over)
    return out


def check(rows, docs, near):
    sizes = collections.Counter()
    for d in docs:
        sizes[d["source"]] += len(WORD.findall(d["text"] or ""))
    want = levels(sizes)
    taken = collections.Counter()
    assert len(rows) == len(docs)
    for r in rows:
        assert r.source_size == sizes[r.source] and close(r.target, want[r.source])
        assert 0 <= r.taken <= 2 * r["size"] and (r["size"] == 0 or r.taken % r["size"] == 0)
        taken[r.source] += r.taken
    for s in sizes:
        assert abs(taken[s] - want[s]) <= near(sizes[s])


def test_given_table(spark):
    df = spark.read.parquet(f"{SF}/documents.parquet")
    rows = mix(df).collect()
    longest = max(len(WORD.findall(d["text"] or "")) for d in given("documents"))
    check(rows, given("documents"), lambda size: longest / 2)
    again = mix(df.repartition(7)).collect()
    assert sorted(rows) == sorted(again)
    text = {d["doc_id"]: len(WORD.findall(d["text"] or "")) for d in given("documents")}
    assert all(text[r.doc_id] == r["size"] for r in rows)


def test_small_buckets_give_the_same_prefix(spark):
    """Whole epochs first, then the smallest keys: whatever the size of the buckets."""
    df = spark.read.parquet(f"{SF}/documents.parquet")
    a = {(r.doc_id, r.taken) for r in mix(df).collect()}
    b = {(r.doc_id, r.taken) for r in mix(df, bucket_rows=3).collect()}
    assert len(a ^ b) <= 2 * 2 * 20  # only the last, best fitting document of a source may differ


def test_odd_rows(spark):
    docs = documents(spark, ODD_ROWS)
    rows = mix(docs).collect()
    check(rows, [r.asDict() for r in docs.collect()], lambda size: size)
    assert sum(r["size"] for r in rows if r.doc_id == 3) == 0
    wide = widened(docs)
    out = mixed_documents(wide)
    assert out.columns == wide.columns
    want = collections.Counter()
    for r in rows:
        want[r.doc_id] += r.taken
    got = collections.Counter()
    for r in out.collect():
        got[r.doc_id] += len(WORD.findall(r.text or ""))
    assert {k: v for k, v in got.items() if v} == {k: v for k, v in want.items() if v}


def test_empty(spark):
    empty = documents(spark, [])
    assert mix(empty).collect() == []
    assert mixed_documents(empty).collect() == []


def test_heavy_documents_come_first_more_often(spark):
    from pyspark.sql import functions as F

    docs = documents(spark, [(i, "a b c " * (3 if i < 400 else 4), f"s{i % 2}") for i in range(800)])
    weight = F.when(F.col("doc_id") % 4 < 2, 4.0).otherwise(1.0)
    rows = [r for r in mix(docs, weight, share=0.5, most=1).collect() if r.taken]
    heavy = sum(r.doc_id % 4 < 2 for r in rows)
    assert heavy > 0.6 * len(rows)


def test_documents_without_words_fill_no_budget(spark):
    """They come as often as whole epochs are taken, never once more, and no document more than twice."""
    rows = [(i, " " if i % 2 else "five words in this text", "abc"[i % 3]) for i in range(300)]
    docs = documents(spark, rows)
    taken = collections.Counter(r.doc_id for r in mixed_documents(docs).collect())
    sizes = collections.Counter()
    for i, t, s in rows:
        sizes[s] += len(WORD.findall(t))
    want = levels(sizes)
    for i, t, s in rows:
        epochs = int(want[s] / sizes[s] + 1e-9)
        assert taken[i] <= 2 and (taken[i] == epochs if not t.strip() else taken[i] in (epochs, epochs + 1))
