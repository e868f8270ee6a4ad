import random

import pytest
from pyspark.sql import functions as F

from citelake.operators import matching as M

ALPHABET = "aab bccé한"


def make(rng):
    text = lambda lo, hi: "".join(rng.choice(ALPHABET) for _ in range(rng.randint(lo, hi)))
    names = {text(1, 14) for _ in range(150)} | {"aaaaaaaa", "aaaaaaa", "é", "한a", "ababab"}
    texts = [text(0, 60) for _ in range(120)] + ["", "aaaaaaaaaaaaaaa", "a", None]
    # Texts that certainly hold long names.
    texts += [text(0, 9) + n + text(0, 9) for n in sorted(names)[:60]]
    return sorted(names), texts


def brute(texts, names):
    return {(i, n) for i, t in enumerate(texts) if t is not None for n in names if n in t}


@pytest.mark.parametrize("limits", [
    {},
    {"in_row_names": 0},
    {"in_row_names": 0, "broadcast_names": 0},
])
def test_every_form_equals_contains(spark, limits):
    names, texts = make(random.Random(7))
    index = M.build_index(
        spark.createDataFrame([(n, n.upper()) for n in [*names, ""]], "name string, up string"),
        payload=["up"], **limits)
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    hits = M.all_hits(df, ["id"], "text", index)
    rows = [(r.id, r.name) for r in hits.collect()]
    expected = brute(texts, names)
    assert len(rows) == len(set(rows)) and set(rows) == expected
    assert all(r.up == r.name.upper() for r in hits.collect())
    best = {r.id: r.name for r in M.best_hits(df, ["id"], "text", index).collect()}
    want = {}
    for i, n in expected:
        want[i] = min(want.get(i, n), n, key=lambda x: (-len(x), x))
    assert best == want


def test_large_dictionary_has_no_nested_loop(spark):
    names = spark.range(2000).select(F.concat(F.lit("Institute "), "id").alias("name"))
    index = M.build_index(names)
    texts = spark.range(100).select("id", F.concat(F.lit("at Institute "), "id").alias("text"))
    hits = M.best_hits(texts, ["id"], "text", index)
    plan = hits._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan and "BroadcastHashJoin" in plan
    assert hits.where(F.col("name") == F.concat(F.lit("Institute "), "id")).count() == 100


def test_small_dictionary_needs_no_join(spark):
    names = spark.createDataFrame([("NATION_1",), ("NATION_10",)], "name string")
    index = M.build_index(names)
    texts = spark.createDataFrame([(1, "in NATION_10"), (2, "in NATION_1"), (3, "no")], "id int, text string")
    best = M.best_hits(texts, ["id"], "text", index)
    plan = best._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Exchange" not in plan
    assert {r.id: r.name for r in best.collect()} == {1: "NATION_10", 2: "NATION_1"}


def test_a_name_in_a_third_of_the_texts_is_spread(spark):
    """Shuffled form: its salts follow its frequency, no task gets much more than the bound, all hits are there."""
    names = spark.range(500).select(F.concat(F.lit("Institute No "), "id").alias("name")).unionByName(
        spark.createDataFrame([("Common",)], "name string"))
    index = M.build_index(names, in_row_names=0, broadcast_names=0)
    number = F.col("id").cast("string")
    text = F.when(F.col("id") % 3 == 0, F.concat(F.lit("Common "), number)).otherwise(F.concat(F.lit("Institute No "), number))
    texts = spark.range(100_000).select("id", text.alias("text"))
    grams = M._with_grams(texts.select("id", F.col("text").alias("_text")), ["id"], index.gram_lengths)
    grams = grams.withColumn("gram", F.xxhash64("gram"))
    salts = M.anchor_salts(grams, index.anchors, 2000)
    by_gram = {r.gram: r["_salts"] for r in salts.collect()}
    common = index.anchors.where("name = 'Common'").first().gram
    assert 17 <= by_gram[common] <= 25
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", 64)
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        found = M._candidates(grams, ["id"], index, 2000).where("name = 'Common'")
        sizes = [r["count"] for r in found.groupBy(F.spark_partition_id()).count().collect()]
        assert sum(sizes) == 33_334 and max(sizes) <= 4 * 2000
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    best = M.best_hits(texts, ["id"], "text", index)
    assert best.where("name = 'Common'").count() == 33_334


@pytest.mark.parametrize("broadcast", [0, 1000])
def test_repeated_names_bring_one_candidate_each(spark, broadcast):
    """A dictionary in which every name comes 50 times has no more anchors than names, and the least payload counts."""
    rows = [(f"Institute {i % 20}", f"C{i // 20:02d}") for i in range(1000)]
    index = M.build_index(
        spark.createDataFrame(rows, "name string, code string"), payload=["code"], in_row_names=0, broadcast_names=broadcast)
    assert index.count == 20 and index.anchors.count() == 20
    texts = spark.createDataFrame([(i, f"at Institute {i}") for i in range(30)], "id int, text string")
    hits = M.best_hits(texts, ["id"], "text", index).collect()
    assert len(hits) == 30 and {r.code for r in hits} == {"C00"}


def test_sieve_keeps_every_anchor_and_few_other_grams(spark):
    names = spark.range(500).select(F.concat(F.lit("Institute "), F.md5(F.col("id").cast("string"))).alias("name"))
    index = M.build_index(names, in_row_names=0)
    assert M.sifted(index.anchors.select("gram"), index).count() == 500
    others = spark.range(20_000).select(F.xxhash64("id").alias("gram"))
    assert M.sifted(others, index).count() < 1000


@pytest.mark.parametrize("limits", [{}, {"broadcast_names": 0}])
def test_long_names_bring_few_false_candidates(spark, limits):
    # All names share their short grams with ten others; a text holds one name.
    names = spark.range(3000).select(F.format_string("Institute#%09d", "id").alias("name"))
    index = M.build_index(names, **limits)
    texts = spark.range(3000).select("id", F.format_string("Dept, Institute#%09d, Elsewhere", "id").alias("_text"))
    grams = M._with_grams(texts, ["id"], index.gram_lengths).withColumn("gram", F.xxhash64("gram"))
    met = M.sifted(grams, index).join(index.anchors, "gram")
    assert 3000 <= met.count() < 3300
    hits = M.best_hits(texts, ["id"], "_text", index)
    assert hits.where(F.col("name") == F.format_string("Institute#%09d", "id")).count() == hits.count() == 3000


def test_candidates_of_texts_travel_once(spark):
    names = spark.range(3000).select(F.format_string("Institute#%09d", "id").alias("name"))
    index = M.build_index(names, broadcast_names=0)
    texts = spark.range(300).select("id", F.format_string("Institute#%09d", "id").alias("text"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        hits = M.best_hits(texts, ["id"], "text", index)
        plan = hits._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # Grams and anchors by gram; candidates and texts by id. Nothing else is dealt out.
    assert plan.count("Exchange hashpartitioning") == 4
