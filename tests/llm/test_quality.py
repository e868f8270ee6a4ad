import random

from pyspark.sql import functions as F

from citelake.llm import quality
from citelake.llm.quality import STATISTICS, Rule, fit, score_quality, text_statistics, tree_rules
from tests.llm.tables import ODD_ROWS, documents, widened
from tests.llm.test_toxicity import LABELS, held


def made(n, seed=5):
    rng = random.Random(seed)
    plain = [f"word{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(300)]
    docs, labels = [], []
    for i in range(n):
        body = [rng.choice(plain) for _ in range(rng.randint(3, 80))]
        if i % 4 == 0:
            body = [[w] * 6 for w in body[:20]] if i % 8 else [w.upper() + "!!" for w in body]
            body = [w for some in body for w in ([some] if isinstance(some, str) else some)]
        docs.append((i, " ".join(body), "s"))
        if rng.random() < 0.7:
            labels.append((i, int(i % 4 != 0), 0))
    return docs, labels


def test_held_out_accuracy(spark):
    docs, labels = made(1500)
    df, marks = documents(spark, docs), spark.createDataFrame(labels, LABELS)
    out = score_quality(df, marks).collect()
    assert len(out) == len(docs)
    assert all(r.held_out == (held(r.doc_id, 4) == 2) and 0 <= r.score <= 1 for r in out)
    assert all(r.predicted == int(r.score >= 0.7) for r in out)
    tested = [r for r in out if r.held_out]
    right = sum(r.predicted == int(r.doc_id % 4 != 0) for r in tested)
    assert len(tested) > 200 and right >= 0.97 * len(tested)
    model = fit(df, marks)
    assert 0 < len(model.rules) < 60 and all(rule.terms for _, rule in model.rules)


def test_compiled_rules_equal_the_plain_ones(spark):
    """The score column against the rules applied one by one in Python."""
    import math

    docs, labels = made(400)
    df, marks = documents(spark, docs), spark.createDataFrame(labels, LABELS)
    model = fit(df, marks)
    for r in score_quality(df, marks).collect():
        values = text_statistics(docs[r.doc_id][1])
        margin = model.intercept + sum(w * values[i] for w, i in model.linear)
        for weight, rule in model.rules:
            if all((values[p] > b) if above else (values[p] <= b) for p, above, b in rule.terms):
                margin += weight
        assert abs(r.score - 1 / (1 + math.exp(-margin))) < 1e-9


def test_odd_rows(spark):
    docs, labels = made(300)
    rows = [(i if i is None else i + 10_000, t, s) for i, t, s in ODD_ROWS] + docs
    wide = widened(documents(spark, rows)).withColumn("_words", F.lit("x"))
    marks = spark.createDataFrame(labels + [(None, 1, 1), (3, None, 0), (77777, 0, 1), labels[0]], LABELS)
    out = score_quality(wide, marks).collect()
    assert len(out) == len(rows) and all(r.score is not None and r.predicted in (0, 1) for r in out)
    for none in ([], [(1, 1, 0)], [(1, 0, 1), (4, 0, 1)]):
        got = score_quality(documents(spark, ODD_ROWS), spark.createDataFrame(none, LABELS)).collect()
        assert len(got) == len(ODD_ROWS) and len({r.score for r in got}) == 1
    assert score_quality(documents(spark, []), marks).collect() == []


def test_tree_paths():
    text = "\n".join(
        ["Tree 0 (weight 1.0):", "    If (feature 2 <= 0.5)", "     If (feature 0 > 1.5)", "      Predict: 0.0",
         "     Else (feature 0 <= 1.5)", "      Predict: 1.0", "    Else (feature 2 > 0.5)", "     Predict: 1.0"]
    )
    assert [r.terms for r in tree_rules(text)] == [
        ((2, False, 0.5),), ((0, True, 1.5), (2, False, 0.5)), ((0, False, 1.5), (2, False, 0.5)), ((2, True, 0.5),),
    ]
    assert set(text_statistics(" ")) == {0.0} and len(text_statistics("a b")) == len(STATISTICS)


def test_every_path_reaches_the_lasso(spark, monkeypatch):
    """150 rules, of which the last one alone tells the labels apart."""
    docs, labels = made(400)
    useless = [Rule(((0, True, 1e9 + i),)) for i in range(149)]
    last = Rule(((STATISTICS.index("twice"), True, 0.3),))
    monkeypatch.setattr(quality, "tree_rules", lambda text: [*useless, last])
    model = fit(documents(spark, docs), spark.createDataFrame(labels, LABELS))
    assert [rule for _, rule in model.rules] == [last]
