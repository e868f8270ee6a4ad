"""Near-duplicate documents by bottom-k sketches of their word shingles.

A document's set holds its distinct shingles of ``width`` words (A-Z
lower-cased), each a 64-bit hash by one hash function; its sketch is the 64
smallest. Two documents are linked if 100 * intersection >= 80 * union; a
group is what links connect.

1. Documents with equal sets are one class, so copies are never paired.
2. Inverted lists: each class stands under every two neighbours of its sketch
   in hash order. Two classes with a similarity of 0.8 share such a pair of
   neighbours: always while the sets have up to 64 shingles (8 to 19: see 5 for
   long lists), else with a chance of a miss below 1e-18. Sets of four to nine shingles that may differ
   in one only are found by leaving out each shingle in turn.
3. Stars: each class is compared with a few list heads (the classes of a list
   whose hash is nearest to fixed numbers, and of a long list the one that is in most
   long lists: the copy with the fewest edits). That is linear in the lists
   and puts large families of near copies into few groups at once.
4. What is left are pairs of stars that share a list but no group. Long lists
   are refined to three, then four neighbours instead of being paired. Classes in lists
   that are still long form the crowd, where texts may be alike to 50 or 70 % by the
   thousand: among each other they meet by step 6 only.
   Pairs whose overlap count or union-sketch estimate (share of the union's
   64 smallest hashes that both have) rules out a link are dropped; the exact
   similarity on full sets decides. If two star centres miss the threshold,
   each star's members are compared with the other centre, and then with each other as far
   as the triangle inequality of the Jaccard distance allows a link, unless
   the two stars are in one group by then.
5. Sets of 8 to 19 shingles need not share a run of four, so a long list may
   miss them. They are indexed under their rarest n - ceil(0.8 n) + 1 shingles, of
   which two that are similar enough share one, and meet in all lists of any
   length, unless they are in one group already or the places of the shingle in
   the two sets rule a link out.
6. The crowd is indexed in the same way, by full sets of any size, so all links in it
   between two groups are found. What is common to many stands last in the order: a
   text with more than a ninth of its own behind which only common shingles follow
   is a candidate of none that is as large.

Documents without words, and rows without id, are linked with nothing. A
document with fewer words than ``width`` has its whole word sequence as one
shingle. Repeated rows fall into one class. Rows of one id with different texts are
classes of their own. Empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from citelake.llm.common import WordHashes, bounded, column_batches, mix64, ordered_pair, small_batches
from citelake.session import stage

K = 64
WIDTH = 5
PERCENT = 80
#: Stars in a list up to which all of them are paired; longer lists are refined first.
LONG = 64
RUNS = (2, 3, 4)
#: Sizes of sets that are paired exactly by their rarest shingles: a union of less than 20 need not share a run of four.
SHORT = (8, 19)
#: Heads of long lists that a class is compared with, besides the others.
TYPICAL = 2
#: Frequent shingles, or classes of the crowd, up to which they are broadcast.
OFTEN = 100_000
#: Overlap count that a candidate needs: a shared run of 2, 3, 4 neighbours counts 1, 2, 3. Sets of up to 64
#: shingles that are similar enough share at least n / 5 - 3 places with a run of four. Of pairs of larger sets with a
#: similarity of 0.8, 3e-13 have less than this if their lists are short, 8e-6 if all of them are long.
OVERLAP = 6
#: A list has a head for each: the class whose number differs from it in the lowest bits only.
HEADS = (0, 0x2545F4914F6CDD1D, -0x61C8864680B583EB)
#: Estimates below which 64 values rule out a similarity of 0.8, 0.6 and 0.4 (chance below one in ten million).
LEAST = (0.5, 0.22, 0.06)
BATCH = 256


def shingle_set(text: str | None, width: int, hashes: WordHashes) -> np.ndarray:
    """The sorted distinct shingle hashes of a text."""
    words = hashes.of((text or "").encode().lower().split())
    if len(words) == 0:
        return words
    count = max(1, len(words) - width + 1)
    grams = mix64(words[:count])
    if len(words) < width:
        for word in words[1:]:
            grams = ordered_pair(grams, np.array([word]))
        return grams
    for shift in range(1, width):
        grams = ordered_pair(grams, words[shift : shift + count])
    return np.unique(grams)


def _fingerprint(values: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(values.tobytes())


def sketches(documents: DataFrame, width: int) -> DataFrame:
    """``doc_id, n, f, sketch``: size and fingerprint of the set, smallest hashes in order."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in column_batches(batches, BATCH):
            sets = [shingle_set(text, width, hashes) for text in batch.column(1).to_pylist()]
            small = [one[:K].view(np.int64) for one in sets]
            offsets = np.concatenate([[0], np.cumsum([len(one) for one in small])]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([len(one) for one in sets], type=pa.int64()),
                    pa.array([_fingerprint(one) for one in sets], type=pa.binary()),
                    pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(small))),
                ],
                names=["doc_id", "n", "f", "sketch"],
            )

    return documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")
    ).mapInArrow(sketch, "doc_id long, n long, f binary, sketch array<long>")


def _run_keys(length: int) -> Column:
    """Structs (place, key) of all runs of ``length`` neighbours in the sketch."""
    return F.transform(
        F.sequence(F.lit(1), F.size("sketch") - (length - 1)),
        lambda i: F.struct(
            i.alias("place"),
            F.xxhash64(F.lit(length), *[F.element_at("sketch", i + j) for j in range(length)]).alias("key"),
        ),
    )


def _small_pairs(classes: DataFrame) -> DataFrame:
    """``a, b``: sets of four to eight shingles, and sets with one more."""
    own = classes.where("n BETWEEN 4 AND 8").select(F.xxhash64("sketch").alias("key"), F.col("f").alias("a"))
    left_out = F.transform(
        F.sequence(F.lit(0), F.size("sketch") - 1),
        lambda i: F.xxhash64(F.filter("sketch", lambda x, j: i != j)),
    )
    larger = classes.where("n BETWEEN 5 AND 9").select(F.explode(left_out).alias("key"), F.col("f").alias("b"))
    return own.join(larger, "key").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))


def _estimated(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """``pairs`` (``a, b, least``) whose union-sketch estimate is at least ``least``."""
    a = classes.select(F.col("f").alias("a"), F.col("sketch").alias("sa"))
    b = classes.select(F.col("f").alias("b"), F.col("sketch").alias("sb"))

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = []
            for x, y in zip(batch.column(3), batch.column(4)):
                p, q = (s.values.to_numpy().view(np.uint64) for s in (x, y))
                union = np.union1d(p, q)[:K]
                both = np.isin(union, p, assume_unique=True) & np.isin(union, q, assume_unique=True)
                held.append(both.sum() / max(1, len(union)))
            mask = np.array(held) >= batch.column(2).to_numpy()
            yield pa.RecordBatch.from_arrays(
                [batch.column(i).filter(pa.array(mask)) for i in range(2)], names=["a", "b"]
            )

    joined = pairs.join(a, "a").join(b, "b").select("a", "b", "least", "sa", "sb")
    return joined.mapInArrow(keep, "a binary, b binary")


def _full_sets(needed: DataFrame, rows: DataFrame, documents: DataFrame, width: int, name: str) -> DataFrame:
    """``f, items``: the full sets of the classes ``needed`` (``f``, distinct), made again from texts, staged."""
    held = rows.join(needed, "f").groupBy("f").agg(F.min("doc_id").alias("doc_id"))

    def full(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in column_batches(batches, BATCH):
            made = [shingle_set(text, width, hashes) for text in batch.column(1).to_pylist()]
            keep = [i for i, (f, one) in enumerate(zip(batch.column(0).to_pylist(), made)) if f == _fingerprint(one)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(keep, type=pa.int32())),
                    pa.array([made[i].tobytes() for i in keep], type=pa.binary()),
                ],
                names=["f", "items"],
            )

    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    sets = texts.join(held, "doc_id").select("f", "text").mapInArrow(full, "f binary, items binary")
    return stage(sets.dropDuplicates(["f"]), f"sets-{name}")


def _similar(pairs: DataFrame, rows: DataFrame, documents: DataFrame, width: int, name: str) -> DataFrame:
    """``a, b, shared, together`` on full sets of the pairs (``a, b``), staged.

    Sets are made again from the texts of the classes that occur in pairs. A
    link means 100 * shared >= 80 * together.
    """
    needed = pairs.select(F.col("a").alias("f")).union(pairs.select("b")).distinct()
    sets = _full_sets(needed, rows, documents, width, name)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in column_batches(batches, BATCH):
            shared, together = [], []
            for x, y in zip(batch.column(2), batch.column(3)):
                p, q = (np.frombuffer(s.as_buffer(), dtype=np.uint64) for s in (x, y))
                both = len(np.intersect1d(p, q, assume_unique=True))
                shared.append(both)
                together.append(len(p) + len(q) - both)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(shared, pa.int64()), pa.array(together, pa.int64())],
                names=["a", "b", "shared", "together"],
            )

    a = sets.select(F.col("f").alias("a"), F.col("items").alias("ia"))
    b = sets.select(F.col("f").alias("b"), F.col("items").alias("ib"))
    joined = pairs.join(a, "a").join(b, "b").select("a", "b", "ia", "ib")
    return stage(joined.mapInArrow(count, "a binary, b binary, shared long, together long"), f"similar-{name}")


def _linked() -> Column:
    return F.col("shared") * 100 >= F.col("together") * PERCENT


def components(edges: DataFrame) -> DataFrame:
    """``f, root`` of every class with an edge (``a, b``): the least class that edges reach.

    Labels fall to the least one beside them, then to the label of their label,
    until none changes. Each round is a written table.
    """
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = stage(both.distinct(), "edges")
    labels = stage(
        both.groupBy(F.col("a").alias("f")).agg(F.min("b").alias("least"))
        .select("f", F.least("f", "least").alias("root")),
        "labels",
    )
    while True:
        beside = (
            both.join(labels.select(F.col("f").alias("b"), "root"), "b")
            .groupBy(F.col("a").alias("f"))
            .agg(F.min("root").alias("near"))
        )
        lower = labels.join(beside, "f").select("f", F.least("root", "near").alias("root"), F.col("root").alias("was"))
        jump = labels.select(F.col("f").alias("root"), F.col("root").alias("next"))
        moved = stage(
            lower.join(jump, "root", "left").select("f", F.least("root", "next").alias("root"), "was"), "labels"
        )
        labels = moved.select("f", "root")
        if moved.where("root <> was").isEmpty():
            return labels


def _with_root(df: DataFrame, roots: DataFrame, column: str, name: str) -> DataFrame:
    joined = df.join(roots.select(F.col("f").alias(column), F.col("root").alias("_root")), column, "left")
    return joined.withColumn(name, F.coalesce("_root", column)).drop("_root")


def _apart(pairs: DataFrame, roots: DataFrame) -> DataFrame:
    """The pairs whose classes are not in one group yet."""
    rooted = _with_root(_with_root(pairs, roots, "a", "ra"), roots, "b", "rb")
    return rooted.where("ra <> rb").drop("ra", "rb")


def _star_pairs(lists: DataFrame, classes: DataFrame, stars: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``a, b, least``: stars that share lists, long lists refined; and ``f``: the crowd, classes in lists long to the last.

    ``lists`` has ``key, f, n, place``, ``stars`` has ``f, star``; the pairs are counted over all lists. Two stars
    are no pair by a list that holds members of the crowd only of both.
    """
    wide = stars.select(F.col("star").alias("s")).distinct().withColumn("wide", F.lit(True))
    held = []
    for run in RUNS:
        starred = lists.join(stars, "f", "left").select("key", "f", "n", "place", F.coalesce("star", "f").alias("s"))
        starred = stage(starred, f"lists-{run}")
        counts = starred.select("key", "s").distinct().groupBy("key").agg(F.count("*").alias("t")).where("t > 1")
        counts = stage(counts, f"counts-{run}")
        held.append((run, starred, counts))
        long = starred.join(counts.where(F.col("t") > LONG), "key", "left_semi")
        if run == RUNS[-1]:
            crowd = stage(long.select("f").distinct(), "crowd")
            break
        again = long.select("f", "place").distinct()
        longer = classes.where(F.size("sketch") > run).select(
            "f", "n", F.explode(_run_keys(run + 1)).alias("at")
        ).select("f", "n", "at.place", "at.key")
        lists = stage(longer.join(again, ["f", "place"]).select("key", "f", "n", "place"), f"runs-{run + 1}")
    known = bounded(crowd.withColumn("known", F.lit(True)), OFTEN)
    found = []
    for run, starred, counts in held:
        short = (
            starred.join(counts.where(F.col("t") <= LONG), "key", "left_semi")
            .join(known, "f", "left")
            .groupBy("key", "s")
            .agg(F.min("n").alias("low"), F.max("n").alias("high"), F.count("*").alias("m"), F.count("known").alias("k"))
            .join(wide, "s", "left")
            .select("key", "s", "low", "high", (F.col("m") == F.col("k")).alias("inner"), F.coalesce("wide", F.lit(False)).alias("wide"))
        )
        short = stage(short, f"short-{run}")
        other = short.select("key", *[F.col(c).alias(f"_{c}") for c in ("s", "low", "high", "inner", "wide")])
        near = (F.col("low") * 100 <= F.col("_high") * (10000 / PERCENT)) & (
            F.col("_low") * 100 <= F.col("high") * (10000 / PERCENT)
        )
        found.append(
            short.join(other, "key")
            .where((F.col("s") < F.col("_s")) & ~(F.col("inner") & F.col("_inner")) & (near | F.col("wide") | F.col("_wide")))
            .select(
                F.col("s").alias("a"),
                F.col("_s").alias("b"),
                F.greatest("low", "_low").alias("n"),
                F.lit(run - 1).alias("votes"),
                (F.col("wide").cast("int") + F.col("_wide").cast("int")).alias("wide"),
            )
        )
    least = F.element_at(F.array(*[F.lit(x) for x in LEAST]), F.col("wide") + 1)
    pairs = (
        reduce(DataFrame.union, found)
        .groupBy("a", "b")
        .agg(F.sum("votes").alias("votes"), F.min("n").alias("n"), F.max("wide").alias("wide"))
        .where(F.col("votes") >= F.least(F.lit(OVERLAP), F.greatest(F.lit(1), F.floor(F.col("n") / 5) - 3)))
        .select("a", "b", least.alias("least"))
    )
    return pairs, crowd


def _prefixes(sets: DataFrame, roots: DataFrame, often: int, name: str) -> DataFrame:
    """``f, n, item, p, root``: the sets (``f, n, items``) under their rarest shingles at places ``p``, where groups meet.

    Two sets that are similar enough share one of their n - ceil(0.8 n) + 1 rarest. Those in up to ``often`` sets
    count as equally rare.
    """
    items = sets.select("f", "n", F.explode("items").alias("item"))
    counts = stage(items.groupBy("item").agg(F.count("*").alias("t")).where(F.col("t") > often), f"often-{name}")
    ordered = (
        items.join(bounded(counts, OFTEN), "item", "left")
        .groupBy("f", "n")
        .agg(F.sort_array(F.collect_list(F.struct(F.coalesce("t", F.lit(0)).alias("t"), "item"))).alias("items"))
    )
    size = (F.col("n") - F.ceil(F.col("n") * PERCENT / 100) + 1).cast("int")
    prefixes = ordered.select("f", "n", F.posexplode(F.slice("items", F.lit(1), size)).alias("p", "one"))
    return _mixed(prefixes.select("f", "n", "p", "one.item"), roots, name)


def _mixed(entries: DataFrame, roots: DataFrame, name: str) -> DataFrame:
    """``entries`` with ``root``, of the items under which classes of several groups stand."""
    entries = stage(_with_root(entries, roots, "f", "root"), f"prefixes-{name}")
    mixed = entries.groupBy("item").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low <> high")
    return stage(entries.join(mixed.select("item"), "item", "left_semi"), f"mixed-{name}")


def _crowd_links(
    crowd: DataFrame, edges: DataFrame, roots: DataFrame, rows: DataFrame, documents: DataFrame, width: int, similar
) -> tuple[DataFrame, DataFrame]:
    """``edges`` and ``roots`` with all links between groups in the ``crowd`` (``f``), by prefixes of full sets.

    Short lists come first: a class that is linked with many of a family shares its rare shingles with some of
    them, so that it is in their group before it could meet all of them.
    """

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in column_batches(batches, BATCH):
            sets = [np.frombuffer(one.as_buffer(), dtype=np.int64) for one in batch.column(1)]
            offsets = np.concatenate([[0], np.cumsum([len(one) for one in sets])]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(sets)))
            sizes = pa.array([len(one) for one in sets], type=pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), sizes, lists], names=["f", "n", "items"])

    sets = _full_sets(crowd, rows, documents, width, "crowd")
    entries = _prefixes(sets.mapInArrow(unpack, "f binary, n long, items array<long>"), roots, 1, "crowd")
    lists = entries.groupBy("item").agg(F.count("*").alias("t")).where(F.col("t") <= LONG)
    pairs = _crowd_pairs(entries.join(lists, "item", "left_semi"))
    for last in (False, True):
        if last:
            pairs = _crowd_pairs(_mixed(entries.drop("root"), roots, "crowd-last"))
        met = similar(pairs, "crowd")
        if met is not None:
            edges = edges.union(met)
            roots = components(edges)
    return edges, roots


def _crowd_pairs(entries: DataFrame) -> DataFrame:
    """``a, b, least``: classes of two groups under one item, unless their places leave too little room for a link."""
    # Room for common shingles from the first common one on: s of a union of n + m - s.
    share, whole = 100 + PERCENT, PERCENT
    smaller = entries.where((F.col("n") - F.col("p")) * share >= whole * 2 * F.col("n"))
    lows = smaller.groupBy("item").agg(F.min("n").alias("low"))
    larger = (
        entries.join(lows, "item")
        .where((F.col("n") - F.col("p")) * share >= whole * (F.col("n") + F.col("low")))
        .select("item", *[F.col(c).alias(d) for c, d in (("f", "g"), ("n", "m"), ("p", "q"), ("root", "other"))])
    )
    room = F.least(F.col("n") - F.col("p"), F.col("m") - F.col("q")) * share >= whole * (F.col("n") + F.col("m"))
    return (
        smaller.join(larger, "item")
        .where("root <> other AND (n < m OR n = m AND f < g)")
        .where(room)
        .select(F.least("f", "g").alias("a"), F.greatest("f", "g").alias("b"))
        .distinct()
        .withColumn("least", F.lit(LEAST[0]))
    )


def _short_pairs(classes: DataFrame, roots: DataFrame) -> DataFrame:
    """``a, b``: all links between groups whose sets have ``SHORT`` sizes, by prefixes in order of frequency."""
    least, most = SHORT
    short = classes.where(F.col("n").between(least, most))
    entries = _prefixes(short.select("f", "n", F.col("sketch").alias("items")), roots, LONG, "short")
    # The first common shingle leaves room for enough common ones behind it.
    places = [(n, p) for n in range(least, most + 1) for p in range(n + (-n * PERCENT // 100) + 1)]
    fits = [
        (n, p, m, q)
        for n, p in places
        for m, q in places
        if (n, p) <= (m, q) and min(n - p, m - q) * (100 + PERCENT) >= PERCENT * (n + m)
    ]
    fits = classes.sparkSession.createDataFrame(fits, "n long, p int, m long, q int")
    other = entries.select("item", *[F.col(c).alias(d) for c, d in (("f", "g"), ("n", "m"), ("p", "q"), ("root", "other"))])
    pairs = (
        entries.join(F.broadcast(fits), ["n", "p"])
        .join(other, ["item", "m", "q"])
        .where("root <> other AND (n <> m OR p <> q OR f < g)")
        .select(F.least("f", "g").alias("a"), F.greatest("f", "g").alias("b"))
        .distinct()
        .withColumn("least", F.lit(PERCENT / 100))
    )
    # Sketches of these sets are the sets, so the estimate is the similarity.
    return _estimated(pairs, classes)


def _number() -> Column:
    """A class as a long, for choosing heads."""
    return F.xxhash64("f")


def _member_links(
    missed: DataFrame, stars: DataFrame, edges: DataFrame, roots: DataFrame, classes: DataFrame, similar
) -> tuple[DataFrame, DataFrame]:
    """``edges`` and ``roots`` with the links between members of stars whose centres are too far apart.

    ``missed`` is ``a, b, gap``, pairs of centres; ``stars`` is ``f, star, far``; ``similar(pairs, name)`` gives exact
    similarities. Members are compared with the other centre first, which takes as many pairs as the stars have members; then
    with each other, if their distances to both centres allow a link and the stars are still in two groups.
    """
    most = (100 - PERCENT) / 100 + 1e-9
    reach = stars.groupBy("star").agg(F.max("far").alias("reach"))
    for side in ("a", "b"):
        own = reach.select(F.col("star").alias(side), F.col("reach").alias(f"reach_{side}"))
        missed = missed.join(own, side, "left").withColumn(f"reach_{side}", F.coalesce(f"reach_{side}", F.lit(0.0)))
    missed = stage(missed, "missed-stars")

    def members(side: str, other: str) -> DataFrame:
        """Members of the star ``side`` that may be near enough to some member of ``other``."""
        member = stars.where("f <> star").select(F.col("star").alias("s"), "f", "far")
        may = F.col("far") + F.col(f"reach_{other}") + most >= F.col("gap")
        return missed.join(member, (F.col("s") == F.col(side)) & may).select(
            "a", "b", f"reach_{other}", "f", "far", F.col(other).alias("centre")
        )

    of_a, of_b = members("a", "b"), members("b", "a")
    # A member within the other star's reach and a link's distance has a similarity of 0.6 or more.
    probes = (
        of_a.select("f", "centre").union(of_b.select("f", "centre"))
        .select(F.least("f", "centre").alias("a"), F.greatest("f", "centre").alias("b"))
        .distinct()
        .withColumn("least", F.lit(LEAST[1]))
    )
    probes = stage(_estimated(probes, classes), "member-probes")
    if probes.isEmpty():
        return edges, roots
    probed = similar(probes, "probes")
    met = probed.where(_linked()).select("a", "b")
    if not met.isEmpty():
        edges = edges.union(met)
        roots = components(edges)

    gaps = probed.select("a", "b", (1 - F.col("shared") / F.col("together")).alias("away"))
    gaps = gaps.select(F.col("a").alias("f"), F.col("b").alias("centre"), "away").union(
        gaps.select(F.col("b").alias("f"), F.col("a").alias("centre"), "away")
    )

    def apart(rows: DataFrame, other: str, names: str) -> DataFrame:
        f, far, away = (f"{name}{names}" for name in ("f", "far", "away"))
        near = rows.join(gaps, ["f", "centre"]).where(F.col("away") <= most + F.col(f"reach_{other}"))
        near = _apart(near.select("a", "b", F.col("f").alias(f), F.col("far").alias(far), F.col("away").alias(away)), roots)
        return stage(near, "member-sides")

    left, right = apart(of_a, "b", "_x").alias("l"), apart(of_b, "a", "_y").alias("r")
    may = (F.col("away_x") <= F.col("far_y") + most) & (F.col("away_y") <= F.col("far_x") + most)
    same = (F.col("l.a") == F.col("r.a")) & (F.col("l.b") == F.col("r.b"))
    near = (
        left.join(right, same & may)
        .select(F.least("f_x", "f_y").alias("a"), F.greatest("f_x", "f_y").alias("b"))
        .distinct()
        .withColumn("least", F.lit(LEAST[0]))
    )
    near = stage(_estimated(near, classes), "members")
    if near.isEmpty():
        return edges, roots
    met = similar(near, "members").where(_linked()).select("a", "b")
    if met.isEmpty():
        return edges, roots
    edges = edges.union(met)
    return edges, components(edges)


def links(documents: DataFrame, rows: DataFrame, width: int) -> DataFrame:
    """``f, root`` of all classes that are linked; ``rows`` is ``sketches`` staged."""
    known = rows.where(F.col("doc_id").isNotNull() & (F.col("n") > 0))
    classes = stage(known.select("f", "n", "sketch").dropDuplicates(["f"]), "classes")
    keyed = classes.where("n >= 8").select("f", "n", F.explode(_run_keys(2)).alias("at"))
    keyed = keyed.select("at.key", "at.place", "f", "n", _number().alias("h"))
    # Numbers, not the fingerprints themselves: only those are aggregated by hash. Two classes of
    # one number are both compared.
    names = [f"head{i}" for i in range(len(HEADS))]
    head = [
        F.min(F.col("h").bitwiseXOR(F.lit(near))).bitwiseXOR(F.lit(near)).alias(name) for near, name in zip(HEADS, names)
    ]
    heads = keyed.groupBy("key").agg(F.count("*").alias("t"), *head).where("t > 1")
    lists = stage(keyed.join(heads, "key"), "lists")
    # A class in most long lists of its list is nearest to what a family has in common, and links most of it.
    long = lists.where(F.col("t") > LONG).select("key", "f", "h")
    rank = F.shiftleft(F.col("long"), 40) + F.col("h").bitwiseAND(F.lit((1 << 40) - 1))
    typical = (
        long.join(long.groupBy("f").agg(F.count("*").alias("long")), "f")
        .groupBy("key").agg(F.max_by("h", rank).alias("head"))
    )
    votes = (
        lists.select("f", "h", F.explode(F.array_distinct(F.array(*names))).alias("head"))
        .where("h <> head")
        .groupBy("f", "head")
        .agg(F.count("*").alias("votes"))
    )
    by_type = long.join(typical, "key").where("h <> head").groupBy("f", "head").agg(F.count("*").alias("votes"))

    def best(votes: DataFrame, most: int) -> DataFrame:
        ordered = F.reverse(F.sort_array(F.collect_list(F.struct("votes", "head"))))
        held = votes.groupBy("f").agg(F.slice(ordered, 1, most).alias("best"))
        return held.select("f", F.explode("best.head").alias("head"))

    numbered = classes.where("n >= 8").select(F.col("f").alias("g"), _number().alias("head"))
    tried = (
        best(votes, len(HEADS)).union(best(by_type, TYPICAL))
        .join(numbered, "head")
        .select(F.least("f", "g").alias("a"), F.greatest("f", "g").alias("b"))
        .union(_small_pairs(classes))
        .distinct()
        .withColumn("least", F.lit(LEAST[0]))
    )
    tried = stage(_estimated(tried, classes), "tried")
    met = _similar(tried, rows, documents, width, "heads").where(_linked())
    roots = components(met)

    # A class belongs to the star of its nearest head; heads are the centres of their own stars.
    far = (1 - F.col("shared") / F.col("together")).alias("far")
    sides = met.select(F.col("a").alias("f"), F.col("b").alias("star"), far).union(
        met.select(F.col("b").alias("f"), F.col("a").alias("star"), far)
    )
    centres = sides.groupBy("star").agg(F.count("*").alias("size"))
    nearest = (
        sides.join(centres, "star")
        .groupBy("f")
        .agg(F.max(F.struct("size", -F.col("far"), "star")).alias("to"))
        .select("f", "to.star", "to.size")
    )
    own = centres.select(F.col("star").alias("f"), F.col("size").alias("own"))
    chosen = stage(
        nearest.join(own, "f").select(
            "f", F.when(F.struct(F.col("own"), F.col("f")) > F.struct(F.col("size"), F.col("star")), F.col("f"))
            .otherwise(F.col("star")).alias("star"),
        ),
        "chosen",
    )
    # A star whose centre chose another star has its members join as classes of their own.
    kept = chosen.where("f = star").select("star")
    stars = chosen.join(kept, "star", "left_semi").join(
        sides.union(centres.select("star", F.col("star").alias("s2"), F.lit(0.0))), ["f", "star"]
    )
    stars = stage(stars.select("f", "star", "far").distinct(), "stars")

    pairs, crowd = _star_pairs(lists.select("key", "f", "n", "place"), classes, stars.select("f", "star"))
    pairs = stage(_estimated(stage(_apart(pairs, roots), "apart"), classes), "star-pairs")
    second = _similar(pairs, rows, documents, width, "stars")
    edges = met.select("a", "b").union(second.where(_linked()).select("a", "b"))
    roots = components(edges)
    short = stage(_short_pairs(classes, roots), "short-pairs")
    if not short.isEmpty():
        edges = edges.union(short)
        roots = components(edges)

    if not crowd.isEmpty():

        def similar(pairs: DataFrame, name: str) -> DataFrame | None:
            """The links among ``pairs``; None if there are none."""
            pairs = stage(_estimated(pairs, classes), f"{name}-pairs")
            if pairs.isEmpty():
                return None
            met = _similar(pairs, rows, documents, width, f"{name}-pairs").where(_linked()).select("a", "b")
            return None if met.isEmpty() else met

        edges, roots = _crowd_links(crowd, edges, roots, rows, documents, width, similar)

    # Centres that are too far apart: members may still be near enough.
    gap = (1 - F.col("shared") / F.col("together")).alias("gap")
    missed = _apart(second.where(~_linked()).select("a", "b", gap), roots)
    return _member_links(
        missed, stars, edges, roots, classes, lambda pairs, name: _similar(pairs, rows, documents, width, name)
    )[1]


def near_duplicates(documents: DataFrame, width: int = WIDTH) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept, f`` of every row of ``documents``.

    ``component_id`` is the smallest id of the group; a row without id has none
    and is kept. ``f`` is the fingerprint of the set.
    """
    small_batches(documents.sparkSession)
    rows = stage(sketches(documents, width), "sketches")
    roots = links(documents, rows, width)
    known = rows.where(F.col("doc_id").isNotNull() & (F.col("n") > 0))
    least = known.groupBy("f").agg(F.min("doc_id").alias("least"))
    grouped = stage(_with_root(least, roots, "f", "root"), "grouped")
    ids = grouped.groupBy("root").agg(F.min("least").alias("component_id"))
    by_class = grouped.join(ids, "root").select("f", "component_id")
    linked = (F.col("n") > 0) & F.col("doc_id").isNotNull()
    component = F.when(linked, F.col("component_id")).otherwise(F.col("doc_id"))
    return rows.join(by_class, "f", "left").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        component.alias("component_id"),
        F.coalesce(component == F.col("doc_id"), F.lit(True)).alias("kept"),
        "f",
    )


def one_of_each_group(documents: DataFrame, width: int = WIDTH) -> DataFrame:
    """The rows of ``documents`` without near-duplicates: of each group the one with the smallest id.

    All columns are kept. Of repeated rows with that id and equal sets one stays; rows
    without id or words all stay.
    """
    groups = near_duplicates(documents, width)
    dropped = stage(groups.where(~F.col("kept")).select("doc_id", "f").distinct(), "dropped")
    packed = documents.select(
        F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("_row"),
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("text").cast("string").alias("text"),
    )
    # An id may stand in several rows: only then does the set say which one is meant.
    repeated = stage(
        documents.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.count("*").alias("n")).where("n > 1").select("doc_id"), "repeated-ids",
    )
    once = packed.join(repeated, "doc_id", "left_anti").join(
        dropped.select("doc_id").distinct(), "doc_id", "left_anti"
    )
    if repeated.isEmpty():
        return once.select("_row.*")
    several = packed.join(repeated, "doc_id", "left_semi")
    marked = _with_fingerprint(several, width).join(dropped, ["doc_id", "f"], "left_anti")
    wordless = marked.where("n = 0").select("_row")
    rest = marked.where("n > 0").groupBy("doc_id", "f").agg(F.first("_row").alias("_row")).select("_row")
    return once.select("_row").union(wordless).union(rest).select("_row.*")


def _with_fingerprint(rows: DataFrame, width: int) -> DataFrame:
    """``rows`` (with ``text``) and ``n, f``."""
    place = rows.columns.index("text")
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in column_batches(batches, BATCH):
            sets = [shingle_set(text, width, hashes) for text in batch.column(place).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns,
                    pa.array([len(one) for one in sets], type=pa.int64()),
                    pa.array([_fingerprint(one) for one in sets], type=pa.binary()),
                ],
                names=[*batch.schema.names, "n", "f"],
            )

    return rows.mapInArrow(add, f"{fields}, n long, f binary")
