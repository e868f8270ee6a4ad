"""URL filter: rules first, else a ratio of two character language models.

A rule fits its host and all subdomains, if the path starts with the rule's;
the longest rule decides, host and path together. Two variable-order Markov
models over characters are trained: on rejected URLs, those with a block word,
and on accepted ones, all others that no rule blocks. A model's chance of a
character given the four before it is interpolated with that given three, two,
one and none, by the share of distinct followers (Witten-Bell), so rare contexts
lean on shorter ones; a URL's own counts are left out of its score. A URL without rule is blocked if the difference of the two log-likelihoods, per
character, is below a threshold, calibrated so that at most
``ACCEPTED_LOST`` of the accepted training URLs would be.

Counts cover every URL of the table and every context of it: a window, five
characters of a URL, is counted exactly and the counts of shorter contexts are
sums of those. Up to ``NEAR_WINDOWS`` different windows the counts are
broadcast. Beyond, each window's chances come from joins of the counts, the
``HEAD_WINDOWS`` most frequent ones are broadcast, and the others, none of
which can be a hot key then, are joined. Both ways give the same scores.

Null urls and urls without ``://`` have empty host and path and no rule; an
empty string is allowed. Repeated rows count again. With training URLs of one
kind only, or none, everything without a rule is allowed.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from citelake.llm.common import column_batches
from citelake.llm.pages import host_of
from citelake.session import stage

ORDER = 4
SYMBOLS = 48
#: Characters of a context: the symbols and the place before the start.
BASE = SYMBOLS + 1
#: Different windows up to which all counts are broadcast, and windows whose chances are broadcast if there are more.
NEAR_WINDOWS, HEAD_WINDOWS = 100_000, 1_000_000
ACCEPTED_LOST = 0.01
#: Bins of the difference in which the accepted URLs are counted for the threshold.
BINS, LEAST, MOST = 4000, -10.0, 10.0
BATCH = 4096

#: The rules of the contract: verdict, host, path.
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)
# Parts of hosts and paths that mark a training URL as rejected.
BLOCK_WORDS = (
    "spam", "casino", "pills", "viagra", "porn", "xxx", "bets", "betting", "lottery", "ads-", "adserver", "track",
    "malware", "phish", "adult", "cheap-", "free-",
)

_ALPHABET = "abcdefghijklmnopqrstuvwxyz0123456789/.-_?=&%:~"
_CODE = np.full(256, SYMBOLS - 1, dtype=np.int64)
_CODE[[ord(c) for c in _ALPHABET]] = np.arange(1, len(_ALPHABET) + 1)


def path_of(url: Column) -> Column:
    """From the end of the host up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?s:.*?)://[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> Column:
    """Struct (rule, verdict) of the longest rule that fits; null without one."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, domain, start in sorted(rules, key=lambda r: (len(r[1] + r[2]), len(r[1]))):
        below = (host == domain) | host.endswith("." + domain)
        fits = below & path.startswith(start)
        out = F.when(fits, F.struct(F.lit(domain + start).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def judged(pages: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES) -> DataFrame:
    """``page_id, host, path, ruled, known``: ``known`` is 1 for accepted, 0 for rejected training URLs."""
    found = pages.select(
        "page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path")
    ).withColumn("ruled", rule_of(F.col("host"), F.col("path"), rules))
    marked = F.lit(False)
    for word in BLOCK_WORDS:
        marked = marked | F.concat("host", "path").contains(word)
    blocked = F.coalesce(F.col("ruled.verdict") == "block", F.lit(False))
    empty = (F.col("host") == "") & (F.col("path") == "")
    known = F.when(marked, 0).when(~blocked & ~empty, 1)
    return found.withColumn("known", known)


def contexts(urls: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Symbols of all URLs, each followed by an end; the codes of their contexts by order; the URLs' ends."""
    raw = [np.append(_CODE[np.frombuffer(u.lower().encode(), dtype=np.uint8)], 0) for u in urls]
    ends = np.cumsum([len(r) for r in raw])
    flat = np.concatenate(raw) if raw else np.empty(0, dtype=np.int64)
    place = np.arange(len(flat)) - np.repeat(ends - [len(r) for r in raw], [len(r) for r in raw])
    cells = np.zeros((ORDER + 1, len(flat)), dtype=np.int64)
    for back in range(1, ORDER + 1):
        before = np.zeros(len(flat), dtype=np.int64)
        before[back:] = flat[:-back] + 1
        before[place < back] = 0
        cells[back] = cells[back - 1] + before * BASE ** (back - 1)
    return flat, cells, ends


class Counts:
    """Counts as an array (kind, order, context, symbol) would hold them; contexts that are not in the table have none."""

    def __init__(self, cells: list[np.ndarray], rows: list[np.ndarray]):
        self.cells, self.rows = cells, rows

    @classmethod
    def of(cls, windows: np.ndarray, numbers: np.ndarray) -> "Counts":
        """From windows and their counts by kind (2, windows)."""
        cells, rows = [], []
        for order in range(ORDER + 1):
            held, at = np.unique(windows // SYMBOLS % BASE**order, return_inverse=True)
            sums = np.zeros((2, len(held) + 1, SYMBOLS), dtype=np.int64)
            for kind in (0, 1):
                np.add.at(sums[kind], (at, windows % SYMBOLS), numbers[kind])
            cells.append(held)
            rows.append(sums)
        return cls(cells, rows)

    def __getitem__(self, at):
        if not isinstance(at, tuple):
            return Counts(self.cells, [r[at] for r in self.rows])
        *kind, order, cell = at
        held = self.cells[order]
        place = np.minimum(np.searchsorted(held, cell), len(held) - 1)
        return self.rows[order][(*kind, np.where(held[place] == cell, place, len(held)))]

    def sum(self) -> int:
        return sum(int(r.sum()) for r in self.rows)


class Models(NamedTuple):
    """The counts (kind, order, context, symbol), kinds being rejected and accepted, and the threshold."""

    counts: Counts
    threshold: float

    def differences(self, urls: list[str], trained: np.ndarray | None = None) -> np.ndarray:
        """Mean log-likelihood difference, accepted minus rejected, of each URL.

        ``trained`` says which model counted a URL (0, 1 or neither); its own
        share in those counts is left out.
        """
        flat, cells, ends = contexts(urls)
        if not len(flat):
            return np.zeros(len(urls))
        starts = np.concatenate([[0], ends[:-1]])
        sizes = ends - starts
        by_symbol = np.full(len(flat), -1) if trained is None else np.repeat(trained, sizes)
        # A window is worked out once for all its places.
        _, one, where = np.unique(
            (cells[ORDER] * SYMBOLS + flat) * 3 + by_symbol + 1, return_index=True, return_inverse=True
        )
        flat, cells, by_symbol = flat[one], cells[:, one], by_symbol[one]
        logs = []
        for kind, counts in enumerate(self.counts):
            own = (by_symbol == kind).astype(np.int64)
            chance = np.full(len(flat), 1 / SYMBOLS)
            for order in range(ORDER + 1):
                rows = counts[order, cells[order]]
                seen = rows[np.arange(len(flat)), flat]
                kinds = (rows > 0).sum(axis=1) - (own & (seen == 1))
                total, seen = np.maximum(rows.sum(axis=1) - own, 0), np.maximum(seen - own, 0)
                chance = np.where(total > 0, (seen + kinds * chance) / np.maximum(total + kinds, 1), chance)
            logs.append(np.log(chance))
        return np.add.reduceat((logs[1] - logs[0])[where], starts) / sizes


def url_windows(rows: DataFrame) -> DataFrame:
    """``window, n0, n1, n`` over all ``url``: how often in rejected, accepted and all rows (``known`` 0, 1, any)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in column_batches(batches, BATCH):
            flat, cells, ends = contexts(batch.column(0).to_pylist())
            known = np.repeat(batch.column(1).to_numpy(), np.diff(ends, prepend=0))
            held, at = np.unique(cells[ORDER] * SYMBOLS + flat, return_inverse=True)
            sums = [np.bincount(at[where], minlength=len(held)) for where in (known == 0, known == 1, slice(None))]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (held, *sums)], names=["window", "n0", "n1", "n"])

    found = rows.select("url", F.coalesce("known", F.lit(-1)).alias("known"))
    return found.mapInArrow(count, "window long, n0 long, n1 long, n long").groupBy("window").agg(
        *[F.sum(c).alias(c) for c in ("n0", "n1", "n")]
    )


def window_differences(windows: DataFrame) -> DataFrame:
    """``window, n, d0, d1, d``: difference of the log-chances of each window, by the model that counted it (d: neither)."""
    below = None
    for order in range(ORDER + 1):
        size = BASE**order * SYMBOLS
        level = windows.groupBy((F.col("window") % size).alias("key")).agg(
            *[F.sum(c).alias(c) for c in ("n0", "n1", "n")]
        )
        context = Window.partitionBy(F.floor(F.col("key") / SYMBOLS))
        for kind in (0, 1):
            level = level.withColumn(f"total{kind}", F.sum(f"n{kind}").over(context)).withColumn(
                f"kinds{kind}", F.count(F.when(F.col(f"n{kind}") > 0, 1)).over(context)
            )
        if below is None:
            level = level.select("*", *[F.lit(1 / SYMBOLS).alias(f"p{k}{o}") for k in (0, 1) for o in (0, 1)])
        else:
            level = level.withColumn("short", F.col("key") % (BASE ** (order - 1) * SYMBOLS)).join(below, "short")
        chances = []
        for kind in (0, 1):
            for own in (0, 1):
                n, before = F.col(f"n{kind}"), F.col(f"p{kind}{own}")
                seen, total = F.greatest(n - own, F.lit(0)), F.greatest(F.col(f"total{kind}") - own, F.lit(0))
                kinds = F.col(f"kinds{kind}") - F.when(n == own, own).otherwise(0)
                chance = (seen + kinds * before) / F.greatest(total + kinds, F.lit(1))
                chances.append(F.when(total > 0, chance).otherwise(before).alias(f"p{kind}{own}"))
        level = level.select("key", "n", *chances)
        names = [f"p{k}{o}" for k in (0, 1) for o in (0, 1)]
        below = level.select(F.col("key").alias("short"), *names)
    return level.select(
        F.col("key").alias("window"),
        "n",
        (F.log("p10") - F.log("p01")).alias("d0"),
        (F.log("p11") - F.log("p00")).alias("d1"),
        (F.log("p10") - F.log("p00")).alias("d"),
    )


def _differences(rows: DataFrame, models: Models) -> DataFrame:
    """``rows`` with their columns ``known, url`` replaced by ``difference``."""
    held = rows.sparkSession.sparkContext.broadcast(models)
    names = [c for c in rows.columns if c not in ("url", "known")]
    fields = "".join(f"`{c}` {rows.schema[c].dataType.simpleString()}, " for c in names)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in column_batches(batches, BATCH):
            trained = batch.column(len(names)).to_numpy()
            scores = held.value.differences(batch.column(len(names) + 1).to_pylist(), trained)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-2], pa.array(scores)], names=[*names, "difference"])

    known = F.coalesce("known", F.lit(-1)).alias("known")
    return rows.select(*names, known, "url").mapInArrow(measure, f"{fields}difference double")


def joined_differences(rows: DataFrame, windows: DataFrame, most: int = HEAD_WINDOWS) -> DataFrame:
    """As ``_differences``, by tables of any size: ``most`` windows are broadcast, the others joined.

    A window that is not among the most frequent ones has at most one part in
    ``most`` of all characters, so neither it nor a URL that holds it is hot.
    """
    scores = stage(window_differences(windows), "window-differences")
    head = scores.orderBy(F.desc("n"), "window").limit(most).select("window", "d0", "d1", "d").toArrow()
    order = np.argsort(head.column("window").to_numpy())
    table = tuple(head.column(c).to_numpy()[order] for c in ("window", "d0", "d1", "d"))
    held = rows.sparkSession.sparkContext.broadcast((table[0], np.stack(table[1:])))
    names = rows.columns
    fields = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in rows.schema.fields)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, by_kind = held.value
        for batch in column_batches(batches, BATCH):
            flat, cells, ends = contexts(batch.column(names.index("url")).to_pylist())
            known = batch.column(names.index("known")).fill_null(2).to_numpy()
            sizes = np.diff(ends, prepend=0)
            windows = cells[ORDER] * SYMBOLS + flat
            place = np.minimum(np.searchsorted(codes, windows), len(codes) - 1)
            here = codes[place] == windows
            found = np.where(here, by_kind[np.repeat(known, sizes), place], 0.0)
            sums = np.add.reduceat(found, ends - sizes) if len(ends) else np.empty(0)
            offsets = np.concatenate([[0], np.cumsum(~here)])[np.concatenate([[0], ends]).astype(np.int64)]
            left = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(windows[~here]))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(sums), pa.array(sizes), left], names=[*names, "_sum", "_size", "_left"]
            )

    partial = rows.mapInArrow(measure, f"{fields}_sum double, _size long, _left array<long>")
    partial = stage(partial, "url-sums")
    out = [c for c in names if c not in ("url", "known")]
    rest = partial.where(F.size("_left") > 0)
    more = (
        rest.select("url", "known", "_left").dropDuplicates(["url"])
        .select("url", "known", F.explode("_left").alias("window"))
        .join(scores, "window")
        .groupBy("url")
        .agg(F.sum(F.when(F.col("known") == 0, F.col("d0")).when(F.col("known") == 1, F.col("d1")).otherwise(F.col("d"))).alias("_more"))
    )
    whole = partial.where(F.size("_left") == 0).select(*out, (F.col("_sum") / F.col("_size")).alias("difference"))
    return whole.union(
        rest.join(more, "url").select(*out, ((F.col("_sum") + F.col("_more")) / F.col("_size")).alias("difference"))
    )


def threshold_of(accepted: DataFrame) -> float:
    """Difference below which at most ``ACCEPTED_LOST`` of the accepted training URLs are, never above 0."""
    step = (MOST - LEAST) / BINS
    bins = accepted.groupBy(
        F.least(F.greatest(F.floor((F.col("difference") - LEAST) / step), F.lit(0)), F.lit(BINS)).alias("bin")
    ).count()
    tally = sorted((r["bin"], r["count"]) for r in bins.collect())
    allowed = ACCEPTED_LOST * sum(n for _, n in tally)
    for place, n in tally:
        allowed -= n
        if allowed < 0:
            return min(0.0, LEAST + place * step)
    return 0.0


def _scored(rows: DataFrame, near: int = NEAR_WINDOWS, head: int = HEAD_WINDOWS) -> tuple[DataFrame, float, Models | None]:
    """``rows`` (``url, known`` among them) with ``difference``, the threshold, and the models if they are broadcast."""
    windows = stage(url_windows(rows), "url-windows")
    size = windows.agg(F.count("*").alias("t"), F.sum("n0").alias("n0"), F.sum("n1").alias("n1")).first()
    if not size["n0"] or not size["n1"]:
        return rows.drop("url", "known").withColumn("difference", F.lit(0.0)), 0.0, None
    if size["t"] <= near:
        table = windows.toArrow()
        numbers = np.stack([table.column(c).to_numpy() for c in ("n0", "n1")])
        models = Models(Counts.of(table.column("window").to_numpy(), numbers), 0.0)
        threshold = threshold_of(_differences(rows.select("url", "known").where("known = 1"), models))
        return _differences(rows, models), threshold, models._replace(threshold=threshold)
    scored = stage(joined_differences(rows.withColumn("_known", F.col("known")), windows, head), "url-differences")
    return scored.drop("_known"), threshold_of(scored.where("_known = 1")), None


def fit(found: DataFrame) -> Models | None:
    """The two models and the threshold from the rows of ``judged``; None without both kinds of URLs or too large to gather."""
    return _scored(found.select(F.concat("host", "path").alias("url"), "known"))[2]


def filter_urls(
    pages: DataFrame,
    rules: Sequence[tuple[str, str, str]] = RULES,
    near: int = NEAR_WINDOWS,
    head: int = HEAD_WINDOWS,
) -> DataFrame:
    """``page_id, host, path, rule, verdict, difference`` of every row of ``pages``."""
    found = judged(pages, rules)
    rows = found.select("page_id", "host", "path", "ruled", "known", F.concat("host", "path").alias("url"))
    scored, threshold, _ = _scored(rows, near, head)
    by_model = F.when((F.col("url_empty")) | (F.col("difference") >= threshold), "allow").otherwise("block")
    return scored.withColumn("url_empty", (F.col("host") == "") & (F.col("path") == "")).select(
        "page_id",
        "host",
        "path",
        F.col("ruled.rule").alias("rule"),
        F.coalesce("ruled.verdict", by_model).alias("verdict"),
        "difference",
    )
