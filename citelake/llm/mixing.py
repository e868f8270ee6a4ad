"""Mix sources to target weights by Efraimidis-Spirakis sampling, in DataFrame functions only.

Every document gets the exponential key ``-ln(u) / w``: ``u`` in (0, 1) from a
hash of its id and text, ``w`` its quality weight. Within a source, whole
epochs are taken first; the words still missing come from the documents with
the smallest keys, up to the budget. Nothing of a source is sorted as a whole:
keys fall into buckets of about ``BUCKET_ROWS`` rows, running sums over the
buckets find the one in which the budget ends, and only that one is sorted.

Null texts have size 0; documents of that size are taken in whole epochs only. A null source is a source of its own, the last. Rows
that agree in id and text share a key and are taken together. Empty input
gives no rows. Columns of the input other than the named ones never matter.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from citelake.llm.common import bounded, word_count
from citelake.session import stage

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST_EPOCHS = 2
BUCKET_ROWS = 20_000
#: Sources up to which the plan is broadcast; more are joined by shuffle.
BROADCAST_SOURCES = 100_000

#: Steepest density of ln(key) for any mixture of weights: e^-1, at the peak of the Gumbel law.
_PEAK = 0.36788


def quality_weight(text: Column) -> Column:
    """1 for plain prose, less with the share of symbols, 0.05 at least."""
    whole = F.length(text)
    symbols = whole - F.length(F.regexp_replace(text, r"[^\p{L}\p{N}\s]+", ""))
    weight = F.greatest(F.lit(0.05), F.lit(1.0) - 2.0 * symbols / whole)
    return F.when(whole > 0, weight).otherwise(F.lit(0.05))


def with_keys(documents: DataFrame, quality: Column | None = None, seed: int = 7) -> DataFrame:
    """``_row, _source, _size, _key``: the document, its source (a struct, so that null joins), words, key."""
    weight = quality_weight(F.col("text")) if quality is None else quality
    bits = F.xxhash64(F.lit(seed), F.col("doc_id"), F.col("text")).bitwiseAND(F.lit((1 << 52) - 1))
    uniform = (bits.cast("double") + 0.5) / float(1 << 52)
    source = F.struct(F.col("source").isNull().alias("missing"), F.coalesce("source", F.lit("")).alias("name"))
    return documents.select(
        F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("_row"),
        source.alias("_source"),
        word_count(F.col("text")).alias("_size"),
        (-F.log(uniform) / weight).alias("_key"),
    )


def targets(
    totals: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    share: float = SHARE,
    most: float = MOST_EPOCHS,
) -> DataFrame:
    """``totals`` (``_source, words, n``) with ``target``.

    ``share`` of all words is dealt by weight; a source stops at ``most`` times
    its words, and the excess goes to the others by weight until none is above.
    That is one water level: with the sources in ascending order of limit over
    weight, the level after the limited ones follows from running sums. One row
    per source is sorted here.
    """
    every = Window.partitionBy()
    place = F.row_number().over(Window.orderBy("_source"))
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    before = Window.orderBy("_ratio", "_place").rowsBetween(Window.unboundedPreceding, -1)
    spread = (
        totals.withColumn("_place", place)
        .withColumn("_weight", F.element_at(cycle, ((F.col("_place") - 1) % len(weights) + 1).cast("int")))
        .withColumn("_limit", F.col("words") * float(most))
        .withColumn("_ratio", F.col("_limit") / F.col("_weight"))
    )
    budget = F.sum("words").over(every) * float(share)
    free = budget - F.coalesce(F.sum("_limit").over(before), F.lit(0.0))
    rest = F.sum("_weight").over(every) - F.coalesce(F.sum("_weight").over(before), F.lit(0.0))
    level = F.max(F.when(F.col("_level") < F.col("_ratio"), F.col("_level"))).over(every)
    dealt = F.coalesce(F.least(F.col("_limit"), level * F.col("_weight")), F.col("_limit"))
    return spread.withColumn("_level", free / rest).select("_source", "words", "n", dealt.alias("target"))


def plan_mix(
    rows: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    share: float = SHARE,
    most: float = MOST_EPOCHS,
    bucket_rows: int = BUCKET_ROWS,
) -> DataFrame:
    """One row per source: ``_source, words, target, epochs, cut_key, last_key``.

    ``rows`` has ``_source, _size, _key`` (stage it: it is read three times). A
    document is taken ``epochs`` times, and once more if its key is at most
    ``cut_key`` or equal to ``last_key``. The cut is the longest prefix within
    the budget; the last document is the one of the same bucket that fits what
    is then left, if taking it comes nearer than leaving it.
    """
    totals = rows.groupBy("_source").agg(F.sum("_size").alias("words"), F.count("*").alias("n"))
    epochs = F.when(F.col("words") > 0, F.floor(F.col("target") / F.col("words"))).otherwise(F.lit(0))
    plan = stage(
        targets(totals, weights, share, most)
        .withColumn("epochs", epochs.cast("long"))
        .withColumn("_rest", F.col("target") - F.col("epochs") * F.col("words"))
        .withColumn("_width", bucket_rows / (_PEAK * F.col("n"))),
        "mix-plan",
    )
    held = bounded(plan.select("_source", "_rest", "_width"), BROADCAST_SOURCES)
    bucket = F.floor(F.log("_key") / F.col("_width"))
    dealt = rows.join(held, "_source").withColumn("_bucket", bucket)
    running = Window.partitionBy("_source").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    crossing = (
        dealt.groupBy("_source", "_bucket", "_rest")
        .agg(F.sum("_size").alias("_held"))
        .withColumn("_before", F.coalesce(F.sum("_held").over(running), F.lit(0)))
        .where((F.col("_before") <= F.col("_rest")) & (F.col("_rest") < F.col("_before") + F.col("_held")))
        .select("_source", "_bucket", "_before")
    )
    keyed = Window.partitionBy("_source").orderBy("_key").rangeBetween(Window.unboundedPreceding, 0)
    inside = dealt.join(bounded(stage(crossing, "mix-crossing"), BROADCAST_SOURCES), ["_source", "_bucket"])
    sums = (
        inside.groupBy("_source", "_bucket", "_before", "_rest", "_key")
        .agg(F.sum("_size").alias("_held"))
        .withColumn("_sum", F.col("_before") + F.sum("_held").over(keyed))
        .withColumn("_fits", F.col("_sum") <= F.col("_rest"))
    )
    whole = Window.partitionBy("_source")
    left = F.col("_rest") - F.coalesce(
        F.max(F.when(F.col("_fits"), F.col("_sum"))).over(whole), F.col("_before")
    )
    cuts = (
        sums.withColumn("_left", left)
        .withColumn("_off", F.when(~F.col("_fits"), F.abs(F.col("_held") - F.col("_left"))))
        .groupBy("_source", "_bucket")
        .agg(
            F.max(F.when(F.col("_fits"), F.col("_key"))).alias("_cut"),
            F.max("_left").alias("_left"),
            F.min(F.when(~F.col("_fits"), F.struct("_off", "_key"))).alias("_last"),
        )
    )
    near = F.col("_last._off") < F.col("_left")
    # A bucket without a fitting key still lets in all buckets below it.
    return (
        plan.join(bounded(stage(cuts, "mix-cuts"), BROADCAST_SOURCES), "_source", "left")
        .withColumn("cut_bucket", F.col("_bucket"))
        .withColumn("cut_key", F.col("_cut"))
        .withColumn("last_key", F.when(near, F.col("_last._key")))
        .select("_source", "words", "target", "epochs", "_width", "cut_bucket", "cut_key", "last_key")
    )


def with_taken(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """``rows`` (``_source, _size, _key``) with the plan's columns and ``_times``, how often each is taken."""
    bucket = F.floor(F.log("_key") / F.col("_width"))
    below = F.coalesce(bucket < F.col("cut_bucket"), F.lit(False))
    cut = F.coalesce(F.col("_key") <= F.col("cut_key"), F.lit(False))
    last = F.coalesce(F.col("_key") == F.col("last_key"), F.lit(False))
    # A document without words fills no budget.
    extra = F.when((below | cut | last) & (F.col("_size") > 0), 1).otherwise(0)
    held = bounded(stage(plan, "mix"), BROADCAST_SOURCES)
    return rows.join(held, "_source").withColumn("_times", F.col("epochs") + extra)


def mix(documents: DataFrame, quality: Column | None = None, seed: int = 7, **how) -> DataFrame:
    """``doc_id, source, size, source_size, target, taken`` of every document, those left out included."""
    keyed = with_keys(documents.select("doc_id", "text", "source"), quality, seed)
    rows = stage(keyed.select("_row.doc_id", "_row.source", "_source", "_size", "_key"), "mix-rows")
    return with_taken(rows, plan_mix(rows, **how)).select(
        "doc_id",
        "source",
        F.col("_size").alias("size"),
        F.col("words").alias("source_size"),
        "target",
        (F.col("_times") * F.col("_size")).cast("long").alias("taken"),
    )


def mixed_documents(documents: DataFrame, quality: Column | None = None, seed: int = 7, **how) -> DataFrame:
    """The rows of ``documents``, each as often as the mix takes it. All columns are kept."""
    keyed = with_keys(documents, quality, seed)
    rows = stage(keyed.select("_source", "_size", "_key"), "mix-rows")
    taken = with_taken(keyed, plan_mix(rows, **how)).where("_times > 0")
    copies = F.explode(F.array_repeat(F.col("_row"), F.col("_times").cast("int")))
    return taken.select(copies.alias("_row")).select("_row.*")
