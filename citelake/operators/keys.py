"""Dense surrogate numbers without a single-task sort."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from citelake.session import stage


def bucket_of(keys: Sequence[str], digits: int) -> Column:
    """The first hex digits of the key's MD5: a pure function of the row."""
    text = F.concat_ws("\x1f", *[F.col(k).cast("string") for k in keys])
    return F.substring(F.md5(text), 1, digits)


#: A column of this name holds the bucket of a row already; the rows are dealt by it.
BUCKET = "_bucket"
ARTICLE_ID = ("doc_id", "source_file")
DIGITS = 3


def dealt_by_bucket(articles: DataFrame, digits: int = DIGITS) -> DataFrame:
    """The articles with their bucket, shuffled by it once: joins on bucket and id and the numbering run where they are.

    Needs a setting that sessions of others may lack; it only saves shuffles, and is set from here on.
    """
    articles.sparkSession.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")
    return articles.withColumn(BUCKET, bucket_of(ARTICLE_ID, digits)).repartition(BUCKET)


def with_bases(
    df: DataFrame,
    sizes: Mapping[str, Column],
    keys: Sequence[str],
    start: Mapping[str, int] | Callable[[Mapping[str, int]], Mapping[str, int]] | None = None,
    digits: int = DIGITS,
    staged: bool = False,
    kept: Sequence[str] | None = None,
) -> DataFrame:
    """Give every row a block of ``sizes[x]`` numbers beginning at ``x_base``.

    Blocks follow each other without gaps in the order (bucket, keys), where a
    row's bucket comes from a hash of ``keys``. The keys must be unique, so
    buckets are even and the numbers are the same whenever the rows are.

    Rows are shuffled once, by bucket, for running totals inside it. The totals
    per bucket are a table of at most ``16 ** digits`` rows, which bounds both
    its broadcast and the running total over buckets. Use more digits for more
    than some 10^9 rows. ``df`` is evaluated twice; with ``staged`` once, being
    written in between, which also makes every later use of the result a scan.

    ``kept`` names the columns to go on with beside ``keys``, all by default.

    ``start`` has the first number of each kind, or is told how many are needed
    and then gives them (``staged`` only).
    """
    if not 1 <= digits <= 4:
        raise ValueError("digits must be between 1 and 4")
    if callable(start) and not staged:
        raise ValueError("numbers can be asked for only once the rows are staged")
    # A bucket that the rows bring along is that of the same keys and digits.
    columns = [c for c in df.columns if c != BUCKET and not c.startswith(_COUNTED) and (kept is None or c in kept or c in keys)]
    bucket = F.col(BUCKET) if BUCKET in df.columns else bucket_of(keys, digits).alias(BUCKET)
    sized = df.select(
        *columns,
        bucket,
        *[size.cast("bigint").alias(f"_size_{x}") for x, size in sizes.items()],
    )
    inside = Window.partitionBy("_bucket").orderBy(*keys).rowsBetween(
        Window.unboundedPreceding, -1
    )
    placed = sized.select(
        *columns,
        "_bucket",
        *[f"_size_{x}" for x in sizes],
        *[
            F.coalesce(F.sum(f"_size_{x}").over(inside), F.lit(0)).alias(f"_inside_{x}")
            for x in sizes
        ],
    )
    if staged:
        placed = stage(placed, "placed")
    totals = (placed if staged else sized).groupBy("_bucket").agg(
        *[F.sum(f"_size_{x}").alias(f"_total_{x}") for x in sizes]
    )
    if callable(start):
        totals = stage(totals, "totals")
        needed = totals.agg(*[F.coalesce(F.sum(f"_total_{x}"), F.lit(0)).alias(x) for x in sizes]).first()
        start = start(needed.asDict())
    start = start or {}
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        "_bucket",
        *[
            (F.coalesce(F.sum(f"_total_{x}").over(before), F.lit(0)) + start.get(x, 1)).alias(
                f"_offset_{x}"
            )
            for x in sizes
        ],
    )
    if staged:
        offsets = stage(offsets, "offsets")
    bases = [(F.col(f"_offset_{x}") + F.col(f"_inside_{x}")).alias(f"{x}_base") for x in sizes]
    return placed.join(F.broadcast(offsets), "_bucket").select(*columns, *bases)


def dense_numbers(
    df: DataFrame, keys: Sequence[str], name: str = "number", start: int = 1, digits: int = 3
) -> DataFrame:
    """Number rows ``start, start+1, …``; ``keys`` must be unique."""
    numbered = with_bases(df, {"row": F.lit(1)}, keys, {"row": start}, digits)
    return numbered.withColumnRenamed("row_base", name)


def different_numbers(df: DataFrame, number: str) -> DataFrame:
    """One row, ``numbers``: how many different numbers there are, NULL not counted.

    Numbers meet as bits, 4 KB for every 32,768 neighbouring ones: the dense numbers made here take an eighth of a byte
    each, where a set of them takes some dozens.
    """
    c = F.col(number).cast("bigint")
    held = df.where(c.isNotNull()).groupBy(F.bitmap_bucket_number(c).alias("_bucket"))
    bits = held.agg(F.bitmap_construct_agg(F.bitmap_bit_position(c)).alias("_bits"))
    return bits.agg(F.coalesce(F.sum(F.bitmap_count("_bits")), F.lit(0)).alias("numbers"))


def batch_numbers(
    df: DataFrame, keys: Sequence[str], size: int = 100_000, name: str = "batch"
) -> DataFrame:
    """Spread rows over batches 1, 2, … of ``size`` rows each."""
    numbered = dense_numbers(df, keys, "_n")
    batch = F.expr(f"(_n - 1) div {int(size)} + 1")
    return numbered.withColumn(name, batch).drop("_n")


def _members(c: Column) -> Column:
    return F.coalesce(F.size(c), F.lit(0))


def affiliation_total(authors: Column) -> Column:
    """How many affiliations of an article become rows."""
    return F.aggregate(
        F.coalesce(authors, F.array()),
        F.lit(0),
        lambda n, a: n
        + F.coalesce(
            F.size(F.filter(a["affiliations"], lambda f: f["affiliation"].isNotNull())), F.lit(0)
        ),
    )


ARTICLE_KEYS = ("author", "affiliation", "reference", "heading", "keyword")


#: How many members a group has that enrichment leaves alone, if counted already.
_COUNTED = "_count_"


def counted(articles: DataFrame) -> DataFrame:
    """The articles with the sizes of their references, headings and keywords, so that numbering does not need these themselves:
    what is not used after it need not be shuffled for it.
    """
    sizes = _article_sizes(articles.columns)
    return articles.withColumns({f"{_COUNTED}{x}": sizes[x] for x in ("reference", "heading", "keyword")})


def _article_sizes(columns: Sequence[str]) -> dict[str, Column]:
    def members(x: str) -> Column:
        return F.col(f"{_COUNTED}{x}") if f"{_COUNTED}{x}" in columns else _members(F.col(f"{x}s"))

    return {
        "author": _members(F.col("authors")),
        "affiliation": affiliation_total(F.col("authors")),
        **{x: members(x) for x in ("reference", "heading", "keyword")},
    }


def number_articles(
    articles: DataFrame,
    start: Mapping[str, int] | Callable[[Mapping[str, int]], Mapping[str, int]] | None = None,
    digits: int = DIGITS,
    staged: bool = False,
    kept: Sequence[str] | None = None,
) -> DataFrame:
    """Reserve the numbers of all members of an article at once.

    The flatteners add a member's position to the article's base, so parents
    and links agree without a join and all flatteners are narrow. ``kept``: the columns to go on with beside the
    article's id, by default all; others are not shuffled or staged.
    """
    return with_bases(
        articles, _article_sizes(articles.columns), list(ARTICLE_ID), start, digits, staged, kept
    )
