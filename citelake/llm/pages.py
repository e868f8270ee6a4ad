"""Main text of web pages: repeated runs of a host's pages are boilerplate.

Pages are read into blocks of text with the path of their elements. The words
of all blocks outside ``article`` and ``main`` form one stream per page and
path. In the suffix array of a host's streams, suffixes that agree in their
first ``RUN`` words stand side by side; here they meet in a group by the hash of
host and words, which Spark combines before it shuffles, so a host
with a third of all pages needs no sorting in one place. A run that groups at
least two pages of different text is a repeated substring, whatever the size of the
host. Repeated runs that overlap or touch make up maximal spans of a stream; a block whose
words all lie in spans is removed, and a block with a word outside them is
a unique run and kept whole. A stream shorter than ``RUN`` words is one run, which
has to repeat under the same path.

Up to ``NEAR_RUNS`` repeated runs are broadcast; beyond, the most frequent ones
are and the rest is joined, with the same result.

A block of ``MAIN_WORDS`` words or more that alone holds more than half of a page's words stays: pages that
share it are near copies of each other, not of one frame.

An exact check on the markup follows: elements that HTML or a whole word of their class, id or
role names as menus, headers, footers, asides, forms, notices, adverts or comments go
even where nothing repeats; text inside ``article`` or ``main`` is never
taken for boilerplate because it repeats (pages may be copies of each other);
and if a page has such an element with text, only text inside it is kept. A form or search
around a whole article is a wrapper: the article starts afresh.

Null or empty html, and pages of markup only, have empty text. Null urls share
one host. Repeated rows each give a row; pages of one text count as one page. Unclosed and
stray tags are borne. Texts are whole, whatever their length.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from html import unescape

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from citelake.llm.common import WordHashes, column_batches, ordered_pair
from citelake.session import stage

RUN = 5
MAIN_WORDS = 40
#: Repeated runs that are broadcast.
NEAR_RUNS = 1_000_000
BATCH = 128

# Element and class names as HTML and common practice have them.
_RAW = frozenset("script style noscript template textarea iframe svg title select option object".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre search section summary table "
    "tbody td tfoot th thead tr ul".split()
)
_CLOSES_P = _BLOCKS - {"body", "html", "td", "th", "tr", "tbody", "thead", "tfoot", "caption"}
_ENDS = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"tr", "table"}, "th": {"tr", "table"}}
_SIBLINGS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}
_CHROME = frozenset("nav footer aside form menu dialog search button label head".split())
_CONTENT = frozenset("article main".split())
_NAMES = frozenset(
    "ad ads advert advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie cookies "
    "copyright disqus footer form gdpr header login masthead menu modal nav navbar navigation newsletter notice "
    "pager pagination popup promo promoted related replies reply search share sharing sidebar signup social sponsor "
    "sponsored subscribe toolbar widget "
    "ad-banner ad-box ad-container ad-slot ad-unit comment-form comment-list comments-area comments-section "
    "cookie-bar cookie-banner cookie-consent cookie-notice disqus_thread footer-links footer-nav global-nav left-nav "
    "login-form main-menu main-nav nav-bar nav-links nav-menu newsletter-signup page-footer page-header post-comments "
    "primary-nav reader-comments related-articles related-links related-posts right-nav search-box search-form "
    "share-buttons side-bar side-nav sidebar-left sidebar-right site-footer site-header site-menu site-nav skip-link "
    "social-links social-share sub-nav subscribe-form top-bar top-menu top-nav user-comments".split()
)
#: What may stand around a whole article.
_WRAPPERS = frozenset("form search".split())
_ROLES = frozenset("alert banner complementary contentinfo dialog form menu menubar navigation search".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|</?[a-zA-Z!?][^>]*(?:>|\Z)|[^<]+|<",
    re.S,
)
_ATTRIBUTE = re.compile(r"(?<![\w-])(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)


class _Open:
    """An open element."""

    __slots__ = ("tag", "name", "chrome", "content", "wrapper")

    def __init__(self, tag: str, attributes: str, above: "_Open | None"):
        found = {a.lower(): x or y or z for a, x, y, z in _ATTRIBUTE.findall(attributes)} if "=" in attributes else {}
        names = f"{found.get('class', '')} {found.get('id', '')}".lower().split()
        role = found.get("role", "").strip().lower()
        self.tag = tag
        self.name = tag + "." + found.get("class", "").strip().lower() if found.get("class") else tag
        begins = tag in _CONTENT or role == "main"
        inside = above is not None and above.content
        self.content = inside or begins
        named = tag not in ("body", "html", "main") and not _NAMES.isdisjoint(names)
        marked = tag in _CHROME or (tag == "header" and not self.content) or role in _ROLES
        around = above is not None and above.chrome and not (begins and not inside and above.wrapper)
        self.chrome = around or named or marked
        # Chrome only by wrappers so far.
        self.wrapper = (above is None or above.wrapper or not above.chrome) and (
            not (named or marked) or (not named and (tag in _WRAPPERS or role in _WRAPPERS))
        )


def blocks_of(html: str | None) -> list[tuple[str, str, bool, bool]]:
    """(path, text, chrome, content) of the blocks of a page in order, without empty ones."""
    html = html or ""
    out: list[tuple[str, str, bool, bool]] = []
    stack: list[_Open] = []
    text: list[str] = []

    def close() -> None:
        if text:
            block = " ".join("".join(text).split())
            text.clear()
            if block:
                top = stack[-1] if stack else None
                path = ">".join(e.name for e in stack)
                out.append((path, block, bool(top and top.chrome), bool(top and top.content)))

    at = 0
    while True:
        got = _TOKEN.match(html, at)
        if got is None:
            break
        at = got.end()
        tag = got[2]
        if tag is None:
            piece = got[0]
            if piece[0] != "<" or piece == "<":
                text.append(unescape(piece))
            continue
        tag = tag.lower()
        if got[1]:
            if tag in _BLOCKS:
                close()
                if any(e.tag == tag for e in stack):
                    while stack.pop().tag != tag:
                        pass
            elif tag == "head" and stack and stack[-1].tag == "head":
                text.clear()
                stack.pop()
            continue
        if tag in _RAW:
            if not got[3].rstrip().endswith("/"):
                end = re.compile(rf"</{re.escape(tag)}\s*>|\Z", re.I).search(html, at)
                at = end.end()
            text.append(" ")
            continue
        if tag == "br":
            text.append(" ")
            continue
        if tag not in _BLOCKS and tag != "head":
            continue
        close()
        if tag == "body":
            while stack and stack[-1].tag == "head":
                stack.pop()
        if tag in _CLOSES_P and stack and stack[-1].tag == "p":
            stack.pop()
        if tag in _SIBLINGS:
            for depth in range(len(stack) - 1, -1, -1):
                if stack[depth].tag in _ENDS[tag]:
                    break
                if stack[depth].tag in _SIBLINGS[tag]:
                    del stack[depth:]
                    break
        if tag not in _VOID:
            stack.append(_Open(tag, got[3], stack[-1] if stack else None))
    close()
    return out


def path_hash(path: str) -> int:
    return xxhash.xxh3_64_intdigest(path) - (1 << 63)


def host_of(url: Column) -> Column:
    """From behind the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without."""
    found = F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?s:.*?)://([^/?#]*)", 1)
    return F.translate(found, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def streams_of(
    blocks: list[tuple[str, str, bool, bool]], host: int, hashes: WordHashes
) -> list[tuple[np.ndarray, list[tuple[int, int, int]]]]:
    """Of each path outside the article: hashes of the runs from each word on, and (block, start, end) in words."""
    words: dict[str, list[bytes]] = {}
    places: dict[str, list[tuple[int, int, int]]] = {}
    for i, (path, text, _, content) in enumerate(blocks):
        if not content:
            held = words.setdefault(path, [])
            start = len(held)
            held.extend(text.encode().lower().split())
            places.setdefault(path, []).append((i, start, len(held)))
    out = []
    for path, held in words.items():
        grams = hashes.of(held)
        count = max(1, len(grams) - RUN + 1)
        runs = grams[:count].copy()
        for shift in range(1, min(RUN, len(grams))):
            runs = ordered_pair(runs, grams[shift : shift + count])
        if len(grams) < RUN:
            runs = ordered_pair(runs, np.array([path_hash(path)]).view(np.uint64))
        runs = ordered_pair(np.full(count, host, dtype=np.int64).view(np.uint64), runs)
        out.append((runs.view(np.int64), places[path]))
    return out


def covered_blocks(
    streams: list[tuple[np.ndarray, list[tuple[int, int, int]]]], repeats: Callable[[np.ndarray], np.ndarray]
) -> set[int]:
    """Blocks all of whose words lie in spans of the runs that ``repeats`` says are repeated.

    A block of ``MAIN_WORDS`` words and more than half of the words of all streams is left out.
    """
    out = set()
    words = sum(places[-1][2] for _, places in streams if places)
    for runs, places in streams:
        hits = np.nonzero(repeats(runs))[0]
        if len(hits):
            size = places[-1][2]
            steps = np.zeros(size + 1, dtype=np.int64)
            np.add.at(steps, hits, 1)
            np.add.at(steps, np.minimum(hits + RUN, size), -1)
            outside = np.concatenate([[0], np.cumsum(np.cumsum(steps)[:size] == 0)])
            out.update(
                block for block, start, end in places
                if outside[start] == outside[end] and (end - start < MAIN_WORDS or 2 * (end - start) <= words)
            )
    return out


def _among(table: np.ndarray, runs: np.ndarray) -> np.ndarray:
    """Which of ``runs`` are in the sorted ``table``."""
    if not len(table):
        return np.zeros(len(runs), dtype=bool)
    return table[np.minimum(np.searchsorted(table, runs), len(table) - 1)] == runs


def _source(pages: DataFrame) -> DataFrame:
    return pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.col("html").cast("string").alias("html"),
        F.xxhash64(host_of(F.col("url"))).alias("host"),
    )


def repeated_runs(source: DataFrame) -> DataFrame:
    """``run, n``: runs on at least two pages of a host with different texts, and on how many rows."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in column_batches(batches, BATCH):
            runs, texts = [np.empty(0, dtype=np.int64)], [np.empty(0, dtype=np.int64)]
            for host, html in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                blocks = blocks_of(html)
                streams = streams_of(blocks, host, hashes)
                if streams:
                    runs.append(np.unique(np.concatenate([r for r, _ in streams])))
                    text = xxhash.xxh3_64_intdigest("\n".join(b[1] for b in blocks)) - (1 << 63)
                    texts.append(np.full(len(runs[-1]), text, dtype=np.int64))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(runs)), pa.array(np.concatenate(texts))], names=["run", "page"]
            )

    found = source.select("host", "html").mapInArrow(read, "run long, page long")
    grouped = found.groupBy("run").agg(F.min("page").alias("low"), F.max("page").alias("high"), F.count("*").alias("n"))
    return grouped.where("low <> high").select("run", "n")


def _with_runs(source: DataFrame, most: int) -> tuple[DataFrame, np.ndarray]:
    """``source`` with ``more``, its repeated runs that are not in the sorted table beside it."""
    repeated = stage(repeated_runs(source), "repeated-runs")
    few = repeated.limit(most + 1).count() <= most
    head = repeated if few else repeated.orderBy(F.desc("n"), "run").limit(most)
    table = np.sort(head.select("run").toArrow().column("run").to_numpy())
    if few:
        return source.withColumn("more", F.lit(None).cast("array<long>")), table
    held = source.sparkSession.sparkContext.broadcast(table)

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in column_batches(batches, BATCH):
            asked = []
            for host, html in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                runs = [r for r, _ in streams_of(blocks_of(html), host, hashes)]
                runs = np.unique(np.concatenate(runs)) if runs else np.empty(0, dtype=np.int64)
                asked.append(runs[~_among(held.value, runs)])
            lists = pa.array(asked, pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column(0), lists], names=["copy", "runs"])

    # A run outside the table is on few pages of different text, so it is no hot key; copies ask once.
    marked = source.withColumn("copy", F.md5(F.concat_ws("|", F.col("host").cast("string"), "html").cast("binary")))
    asked = marked.select("copy", "host", "html").mapInArrow(ask, "copy string, runs array<long>")
    more = (
        asked.dropDuplicates(["copy"])
        .select("copy", F.explode("runs").alias("run"))
        .join(repeated, "run")
        .groupBy("copy")
        .agg(F.collect_list("run").alias("more"))
    )
    return marked.join(stage(more, "page-runs"), "copy", "left").drop("copy"), table


def _covered(
    html: str | None, host: int, more: list[int] | None, table: np.ndarray, hashes: WordHashes
) -> tuple[list[tuple[str, str, bool, bool]], set[int]]:
    """The blocks of a page and which of them are covered."""
    blocks = blocks_of(html)
    own = np.sort(np.array(more or [], dtype=np.int64))
    return blocks, covered_blocks(streams_of(blocks, host, hashes), lambda r: _among(table, r) | _among(own, r))


def boilerplate_paths(pages: DataFrame) -> DataFrame:
    """``host, paths``: hashes of the paths of covered blocks, to look into what repeats on a host."""
    rows, table = _with_runs(_source(pages), NEAR_RUNS)
    held = pages.sparkSession.sparkContext.broadcast(table)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in column_batches(batches, BATCH):
            found = set()
            for html, host, more in zip(*(batch.column(i).to_pylist() for i in range(3))):
                blocks, covered = _covered(html, host, more, held.value, hashes)
                found |= {(host, path_hash(blocks[i][0])) for i in covered}
            columns = [pa.array([f[i] for f in found], pa.int64()) for i in (0, 1)]
            yield pa.RecordBatch.from_arrays(columns, names=["host", "path"])

    found = rows.select("html", "host", "more").mapInArrow(read, "host long, path long")
    return found.groupBy("host").agg(F.collect_set("path").alias("paths"))


def main_text(blocks: list[tuple[str, str, bool, bool]], covered: set[int]) -> str:
    """The blocks that are kept, one a line; ``covered`` has the places of those that repeat."""
    left = [b for i, b in enumerate(blocks) if not b[2] and i not in covered]
    inside = [b for b in left if b[3]]
    return "\n".join(b[1] for b in inside or left)


def extract_text(pages: DataFrame, most: int = NEAR_RUNS) -> DataFrame:
    """``page_id, url, text, n_chars`` of every row of ``pages``."""
    rows, table = _with_runs(_source(pages), most)
    held = pages.sparkSession.sparkContext.broadcast(table)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in column_batches(batches, BATCH):
            found = zip(*(batch.column(i).to_pylist() for i in (2, 3, 4)))
            texts = [main_text(*_covered(html, host, more, held.value, hashes)) for html, host, more in found]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                names=["page_id", "url", "text", "n_chars"],
            )

    return rows.select("page_id", "url", "html", "host", "more").mapInArrow(
        read, "page_id long, url string, text string, n_chars long"
    )
