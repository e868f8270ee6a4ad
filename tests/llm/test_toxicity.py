import random
import zlib

from pyspark.sql import functions as F

from citelake.llm.toxicity import Lexicon, remainder, score_toxicity, text_features, without_toxic
from tests.llm.tables import ODD_ROWS, documents, given, widened

LABELS = "doc_id long, quality int, toxic int"


def held(doc_id, parts):
    return 1 if doc_id is None else zlib.crc32(str(doc_id).encode()) % parts


def made(n, seed=5):
    rng = random.Random(seed)
    plain = [f"word{i}" for i in range(300)]
    rude = ["gruftle", "snarbly", "vexomat", "blorgish", "dwimp"]
    docs, labels = [], []
    for i in range(n):
        body = [rng.choice(plain) for _ in range(rng.randint(3, 80))]
        toxic = i % 5 == 0
        if toxic:
            for _ in range(rng.randint(1, 3)):
                body.insert(rng.randrange(len(body)), rng.choice(rude))
        docs.append((i, " ".join(body), "s"))
        if rng.random() < 0.7:
            labels.append((i, 1, int(toxic)))
    return docs, labels


def test_held_out_accuracy(spark):
    docs, labels = made(1200)
    out = score_toxicity(documents(spark, docs), spark.createDataFrame(labels, LABELS)).collect()
    assert len(out) == len(docs)
    truth = {i: int(i % 5 == 0) for i, _, _ in docs}
    assert all(r.held_out == (held(r.doc_id, 5) == 0) and 0 <= r.score <= 1 for r in out)
    assert all(r.predicted == int(r.score >= 0.5) for r in out)
    tested = [r for r in out if r.held_out]
    right = sum(r.predicted == truth[r.doc_id] for r in tested)
    assert right >= 0.97 * len(tested)
    left = without_toxic(documents(spark, docs), spark.createDataFrame(labels, LABELS))
    assert {r.doc_id for r in left.collect()} == {r.doc_id for r in out if not r.predicted}


def test_held_out_labels_do_not_matter(spark):
    docs, labels = made(400)
    turned = [(i, q, 1 - t if held(i, 5) == 0 else t) for i, q, t in labels]
    df = documents(spark, docs)
    a = score_toxicity(df, spark.createDataFrame(labels, LABELS)).collect()
    b = score_toxicity(df, spark.createDataFrame(turned, LABELS)).collect()
    assert sorted(a) == sorted(b)


def test_odd_rows(spark):
    docs, labels = made(300)
    rows = [(i if i is None else i + 10_000, t, s) for i, t, s in ODD_ROWS] + docs
    wide = widened(documents(spark, rows)).withColumn("_score", F.lit(1))
    marks = spark.createDataFrame(labels + [(None, 1, 1), (3, 1, None), (77777, 0, 1), labels[0]], LABELS)
    out = score_toxicity(wide, marks).collect()
    assert len(out) == len(rows) and all(r.score is not None and r.predicted in (0, 1) for r in out)
    kept = without_toxic(wide, marks)
    assert kept.columns == wide.columns and kept.count() == sum(not r.predicted for r in out)
    for none in ([], [(1, 1, 0)], [(1, 1, 1), (2, 1, 1)]):
        got = score_toxicity(documents(spark, ODD_ROWS), spark.createDataFrame(none, LABELS)).collect()
        assert len(got) == len(ODD_ROWS) and len({r.score for r in got}) == 1
    assert score_toxicity(documents(spark, []), marks).collect() == []


def test_features():
    lexicon = Lexicon(frozenset({"idiot"}), frozenset({"idiot"}))
    got = text_features("You IDIOT! an 1d10t here, idiotic", lexicon)
    assert got[:6] == (1.0, 1 / 6, 2.0, 2 / 6, 1.0, 1.0)
    assert set(text_features(None, lexicon)) == set(text_features("  ", lexicon)) == {0.0}


def test_remainder(spark):
    rows = spark.range(50).select(remainder(F.col("id"), 5).alias("r"), "id").collect()
    assert all(r.r == held(r.id, 5) for r in rows)
    assert given("labels")


def test_second_person_is_counted_near_all_hits():
    lexicon = Lexicon(frozenset({"fool"}), frozenset())
    apart = " and so on it goes for quite a while "
    text = ("fool" + apart) * 1500 + ("you fool" + apart) * 500
    assert text_features(text, lexicon)[4] == 500.0
    assert text_features("fool" + " a" * 6 + " you", lexicon)[4] == 0.0
    assert text_features("you" + " a" * 5 + " fool", lexicon)[4] == 1.0
