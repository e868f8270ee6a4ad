"""Find dictionary names inside free text: all hits, or the longest.

The reading is exact and case-sensitive: a name matches where the text contains
it. Of several names in one text the longest wins, ties by name ascending.

Two physical forms, chosen by the measured size of the dictionary:

* a small one becomes a constant array and is tested inside the row, without
  any join or shuffle;
* a large one is indexed by one anchor gram per name, the gram rarest among
  all names, longer for long names. The texts' grams meet the anchors in an equi-join, broadcast while
  the index is within its bound and shuffled beyond it, and each candidate is
  then verified with ``contains``. Grams that no anchor can equal are sifted out
  before the join, by a bit set of the anchors. In the shuffle an anchor that stands in very
  many texts is spread over as many keys as its measured frequency asks for.

A large dictionary is first reduced to one row per name, the one with the least
payload: a name that comes n times would bring n candidates per text.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row, functions as F

from citelake.session import stage

GRAM = 6
#: Names that are long enough have longer grams: few texts hold one by chance.
LONG_GRAM = 12
IN_ROW_NAMES = 300
BROADCAST_NAMES = 1_000_000
BROADCAST_CHARS = 48_000_000
#: Rows one frequent gram may bring to a task; grams looked at for it, and kept track of by the sketch.
SALT_ROWS = 100_000
FREQUENT, TRACKED = 1000, 10_000
PIECES = (8192, 128)
#: Bits per name in the set of anchors, and the most words of 64 bits it may have (2 MB).
SIEVE_BITS, SIEVE_WORDS = 64, 1 << 18


@dataclass(frozen=True)
class NameIndex:
    """A dictionary prepared for matching. ``payload`` columns come with each hit."""

    payload: tuple[str, ...]
    count: int
    entries: list[dict] | None = None  # small: the entries themselves, best first
    anchors: DataFrame | None = None  # large: hash of the gram, name, payload columns
    gram_lengths: tuple[int, ...] = ()
    broadcast: bool = True
    sieve: DataFrame | None = None  # large: one row, the anchors' bits as an array of words

    @property
    def in_row(self) -> bool:
        return self.entries is not None

    @property
    def hit_type(self) -> str:
        return "struct<" + ", ".join(f"{c}:string" for c in ("name", *self.payload)) + ">"


def build_index(
    dictionary: DataFrame,
    name: str = "name",
    payload: Sequence[str] = (),
    in_row_names: int = IN_ROW_NAMES,
    broadcast_names: int = BROADCAST_NAMES,
    broadcast_chars: int = BROADCAST_CHARS,
) -> NameIndex:
    """Index ``dictionary`` (one row per name). Blank names are left out: every
    text would contain them.
    """
    payload = tuple(payload)
    names = stage(
        dictionary.where(F.col(name) != "").select(
            F.col(name).alias("name"), *[F.col(c).cast("string").alias(c) for c in payload]
        ),
        "names",
    )
    size = _size(names)
    if size["n"] > in_row_names:
        names = stage(_one_per_name(names, payload), "unique")
        size = _size(names)
    if size["n"] <= in_row_names:
        # At most `in_row_names` rows reach the driver.
        rows = names.collect()
        entries = [row.asDict() for row in rows]
        entries.sort(key=lambda e: (-len(e["name"]), e["name"]))
        return NameIndex(payload, size["n"], entries=entries)
    anchors = stage(_anchors(names, payload), "anchors")
    return NameIndex(
        payload,
        size["n"],
        anchors=anchors,
        gram_lengths=tuple(sorted(size["lengths"])),
        broadcast=size["n"] <= broadcast_names and size["chars"] <= broadcast_chars,
        sieve=stage(_sieve(anchors, size["n"]), "sieve"),
    )


def _size(names: DataFrame) -> Row:
    return names.agg(
        F.count(F.lit(1)).alias("n"),
        F.coalesce(F.sum(F.length("name")), F.lit(0)).alias("chars"),
        F.collect_set(_gram_length(F.length("name"))).alias("lengths"),
    ).first()


def _gram_length(name_length: Column) -> Column:
    return F.when(name_length >= LONG_GRAM, LONG_GRAM).otherwise(F.least(name_length, F.lit(GRAM)))


def _one_per_name(names: DataFrame, payload: tuple[str, ...]) -> DataFrame:
    """Of entries with one name that with the least payload, as ``_best`` takes it."""
    if not payload:
        return names.distinct()
    least = names.groupBy("name").agg(F.min(F.struct(*payload)).alias("_least"))
    return least.select("name", *[F.col(f"_least.{c}").alias(c) for c in payload])


def _sieve_word(gram: Column, words: Column | int) -> Column:
    return gram.bitwiseAND(words - 1).cast("int")


def _sieve_bits(gram: Column) -> list[Column]:
    """The two bits of a word: a gram that is no anchor seldom finds both set."""
    return [F.shiftrightunsigned(gram, by).bitwiseAND(63).cast("int") for by in (58, 52)]


def _sieve(anchors: DataFrame, names: int) -> DataFrame:
    """One row: an array of words in which every anchor has set its bits."""
    words = 64
    while words < SIEVE_WORDS and words * 64 < names * SIEVE_BITS:
        words *= 2
    one = F.lit(1).cast("bigint")
    first, second = [F.call_function("shiftleft", one, bit) for bit in _sieve_bits(F.col("gram"))]
    bits = first.bitwiseOR(second)
    held = anchors.groupBy(_sieve_word(F.col("gram"), words).alias("_word")).agg(F.bit_or(bits).alias("_bits"))
    every = anchors.sparkSession.range(words).select(F.col("id").cast("int").alias("_word"))
    pairs = every.join(held, "_word", "left").select(F.struct("_word", F.coalesce("_bits", F.lit(0).cast("bigint")).alias("_bits")).alias("p"))
    return pairs.agg(F.array_sort(F.collect_list("p")).alias("p")).select(F.col("p._bits").alias("words"))


def sifted(grams: DataFrame, index: NameIndex) -> DataFrame:
    """The rows whose ``gram`` may be an anchor: all that are one, few others."""
    words, gram = index.sieve.scalar(), F.col("gram")
    word = F.get(words, _sieve_word(gram, F.size(words)))
    for bit in _sieve_bits(gram):  # the second is looked at for the few that pass the first
        grams = grams.where(F.call_function("shiftrightunsigned", word, bit).bitwiseAND(F.lit(1).cast("bigint")) == 1)
    return grams


def _pieces(text: Column, size: int, overlap: int) -> Column:
    """``text`` in pieces of ``size`` characters, each with the next ``overlap`` added."""
    last = F.ceil(F.char_length(text) / size).cast("int") - 1
    return F.transform(
        F.sequence(F.lit(0), F.greatest(last, F.lit(0))),
        lambda i: F.substring(text, i * size + 1, F.lit(size + overlap)),
    )


def _with_grams(texts: DataFrame, ids: Sequence[str], lengths: Sequence[int]) -> DataFrame:
    """``ids, _text, _length, gram``: every substring of the given lengths, by its start.

    Positions are exploded and cut out in generated code. Texts go in pieces
    first, as finding a position counts characters from the start; pieces
    overlap, so no substring is lost. Some may come twice, and near a text's end
    shorter ones appear: both are settled when candidates are verified.
    """
    ids = list(ids)
    overlap = max(lengths, default=1) - 1
    large, small = PIECES
    pieces = F.flatten(
        F.transform(
            _pieces(F.col("_text"), large, overlap), lambda piece: _pieces(piece, small, overlap)
        )
    )
    starts = F.sequence(F.lit(1), F.least(F.char_length("_piece"), F.lit(small)))
    rows = (
        texts.where(F.col("_text") != "")
        # Nothing here is empty; an outer explode gets no inferred filter, which would work the array out again.
        .select(*ids, "_text", F.explode_outer(pieces).alias("_piece"))
        .select(*ids, "_text", "_piece", F.explode_outer(starts).alias("_start"))
    )
    if len(lengths) == 1:
        rows = rows.withColumn("_length", F.lit(lengths[0]))
    else:
        rows = rows.withColumn("_length", F.explode(F.lit(list(lengths))))
    gram = F.substring(F.col("_piece"), F.col("_start"), F.col("_length"))
    return rows.select(*ids, "_text", "_length", gram.alias("gram"))


def _anchors(names: DataFrame, payload: tuple[str, ...]) -> DataFrame:
    """One gram per name; a name shorter than a gram is its own anchor."""
    long_names = names.where(F.length("name") > GRAM).select("name", F.col("name").alias("_text"))
    size = _gram_length(F.length("name"))
    grams = (
        _with_grams(long_names, ["name"], [GRAM, LONG_GRAM])
        .where((F.char_length("gram") == size) & (F.col("_length") == size))
        .select("name", "gram")
        .distinct()
    )
    frequency = grams.groupBy("gram").agg(F.count(F.lit(1)).alias("n"))
    rarest = (
        grams.join(frequency, "gram")
        .groupBy("name")
        .agg(F.min(F.struct("n", "gram")).alias("a"))
        .select("name", F.col("a.gram").alias("gram"))
    )
    short = names.where(F.length("name") <= GRAM).withColumn("gram", F.col("name"))
    anchors = (
        names.join(rarest, "name")
        .select("gram", "name", *payload)
        .unionByName(short.select("gram", "name", *payload))
    )
    return anchors.withColumn("gram", F.xxhash64("gram"))


def _constant(index: NameIndex) -> Column:
    text = json.dumps(index.entries, ensure_ascii=False)
    return F.from_json(F.lit(text), f"array<{index.hit_type}>")


def hits_in_row(text: Column, index: NameIndex) -> Column:
    """Small dictionaries: the array of entries the text contains, best first."""
    return F.filter(_constant(index), lambda e: F.contains(text, e["name"]))


def all_hits(texts: DataFrame, ids: Sequence[str], text: str, index: NameIndex) -> DataFrame:
    """``ids, name, payload``: every dictionary name each text contains.

    ``ids`` must identify a text.
    """
    ids = list(ids)
    out = ["name", *index.payload]
    if index.in_row:
        hit = F.explode(hits_in_row(F.col(text), index)).alias("hit")
        return texts.select(*ids, hit).select(*ids, *[F.col(f"hit.{c}").alias(c) for c in out])

    return _gram_hits(texts, ids, text, index).dropDuplicates([*ids, "name"])


def _gram_hits(texts: DataFrame, ids: list[str], text: str, index: NameIndex) -> DataFrame:
    """Verified hits; a name whose anchor occurs again in a text comes again."""
    out = ["name", *index.payload]
    texts = texts.select(*ids, F.col(text).alias("_text"))
    # Hashes make a cheaper join key than strings; verification settles collisions.
    grams = _with_grams(texts, ids, index.gram_lengths).withColumn("gram", F.xxhash64("gram"))
    grams = sifted(grams, index)
    if index.broadcast:
        return (
            grams.join(F.broadcast(index.anchors), "gram")
            .where(F.contains("_text", "name"))
            .select(*ids, *out)
        )
    if text in ids:
        return _candidates(grams, ids, index).where(F.contains(text, "name")).select(*ids, *out)
    # The texts themselves travel once, for the candidates' verification, and the candidates once, to them.
    return (
        _candidates(grams, ids, index).select(*ids, *out)
        .join(texts, ids)
        .where(F.contains("_text", "name"))
        .select(*ids, *out)
    )


def anchor_salts(grams: DataFrame, anchors: DataFrame, rows: int = SALT_ROWS) -> DataFrame:
    """``gram, _salts``: anchors that bring more than ``rows`` candidates, and over how many keys they go.

    Frequencies come from a sketch of all grams, bounded in size however many
    there are: it knows every gram that makes up more than about one in
    ``0.75 * TRACKED`` of them, and never less than its true number.
    """
    found = grams.agg(F.expr(f"approx_top_k(gram, {FREQUENT}, {TRACKED})").alias("top")).first()["top"] or []
    counts = grams.sparkSession.createDataFrame(
        [(r["item"], r["count"]) for r in found if r["count"] > rows], "gram bigint, n bigint"
    )
    held = anchors.join(F.broadcast(counts), "gram").groupBy("gram").agg(F.first("n").alias("n"), F.count("*").alias("names"))
    salts = F.ceil(F.col("n") * F.col("names") / rows).cast("int")
    return stage(held.select("gram", salts.alias("_salts")), "salts")


def _candidates(grams: DataFrame, ids: list[str], index: NameIndex, rows: int = SALT_ROWS) -> DataFrame:
    """Texts' ids beside the anchors that stand in them; frequent anchors are spread by text."""
    salts = F.broadcast(anchor_salts(grams, index.anchors, rows))  # FREQUENT rows at most
    many = F.coalesce("_salts", F.lit(1))
    spread = grams.join(salts, "gram", "left").select(
        *ids, "gram", F.pmod(F.xxhash64(*ids), many).cast("int").alias("_salt")
    )
    anchors = index.anchors.join(salts, "gram", "left").withColumn("_salt", F.explode(F.sequence(F.lit(0), many - 1)))
    return spread.join(anchors.drop("_salts"), ["gram", "_salt"])


def _best(out: Sequence[str]) -> Column:
    ranked = F.min(F.struct((-F.length("name")).alias("_rank"), *[F.col(c) for c in out]))
    return ranked.alias("_best")


def best_hits(texts: DataFrame, ids: Sequence[str], text: str, index: NameIndex) -> DataFrame:
    """``ids, name, payload``: the winning name of each text that has one."""
    ids, out = list(ids), ["name", *index.payload]
    if index.in_row:
        first = F.explode(F.slice(hits_in_row(F.col(text), index), 1, 1))
        return texts.select(*ids, first.alias("hit")).select(
            *ids, *[F.col(f"hit.{c}").alias(c) for c in out]
        )
    hits = _gram_hits(texts, ids, text, index)
    return (
        hits.groupBy(*ids)
        .agg(_best(out))
        .select(*ids, *[F.col(f"_best.{c}").alias(c) for c in out])
    )


def best_per_article(
    texts: DataFrame, ids: Sequence[str], array: str, index: NameIndex, name: str, by: Sequence[str] | None = None
) -> DataFrame:
    """``ids, name``: for an array of texts per row, a map text → winning entry.

    Only hits are shuffled, once, by ``ids`` or those of them that ``by`` names.
    """
    ids, out = list(ids), ["name", *index.payload]
    # Outer, so that no inferred filter works the array out again; a row without texts finds nothing.
    each = texts.select(*ids, F.explode_outer(array).alias("_each"))
    # The text is part of the id here: a row's texts are distinct.
    by_text = [*ids, "_each"]
    hits = (
        all_hits(each, by_text, "_each", index)
        if index.in_row
        else _gram_hits(each, by_text, "_each", index)
    ).repartition(*[F.col(c) for c in by or ids])
    best = hits.groupBy(*ids, "_each").agg(_best(out))
    entry = F.struct(F.col("_each"), F.struct(*[F.col(f"_best.{c}").alias(c) for c in out]))
    return best.groupBy(*ids).agg(F.map_from_entries(F.collect_list(entry)).alias(name))
