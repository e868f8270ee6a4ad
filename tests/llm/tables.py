"""Small tables with the cases every operator must bear: nulls, empty and long texts, ties, repeated rows, more columns."""

import math
import re

import pyarrow.parquet as pq

SF = "/root/testdata/sf0.001"
WORD = re.compile("[^\x20\x09-\x0d]+")

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, rows):
    """Rows (doc_id, text, source); the other columns are filled in."""
    full = [(i, t, "en", s, None if t is None else len(t)) for i, t, s in rows]
    return spark.createDataFrame(full, DOCUMENTS)


def given(name, sf=SF):
    return pq.read_table(f"{sf}/{name}.parquet").to_pylist()


ODD_ROWS = [
    (1, None, "a"),
    (2, "", "a"),
    (3, " \t\n\x0b\f\r ", None),
    (4, "one", None),
    (5, "same words here again", "b"),
    (6, "same words here again", "b"),
    (6, "same words here again", "b"),
    (None, "no id at all", "c"),
    (None, None, None),
    (7, "long " * 30_000 + "end", "c"),
    (8, "Ünïcödé — ‘quotes’ \U0001f600 and spaces here", "ß"),
]

CLASHING = "_row string, _key int, _size string, _source int, part int, score string, features string, label int, word int, value int, prediction int"


def widened(df):
    """``df`` with columns named like the operators' own."""
    return df.selectExpr("*", *[f"cast(null as {t}) as {n}" for n, t in (c.strip().split(" ") for c in CLASHING.split(","))])


def close(a, b, by=1e-6):
    return math.isclose(a, b, rel_tol=by, abs_tol=by)
