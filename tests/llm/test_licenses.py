import math
import re

import pytest

from citelake.llm.licenses import NOTICES, fit, scan_licenses
from tests.llm.tables import ODD_ROWS, SF, documents, given, widened


@pytest.fixture(scope="module")
def model(spark):
    return fit(spark)


def test_notices_are_found(spark, model):
    rows = [(i, f"first line\n{n}\nlast of all", f) for i, (n, f) in enumerate((n, f) for f in NOTICES for n in NOTICES[f])]
    got = {r.doc_id: (r.paragraph, r.family) for r in scan_licenses(documents(spark, rows), model).collect()}
    right = sum(got.get(i) == (1, f) for i, _, f in rows)
    assert right >= len(rows) - 3
    assert all(i not in got or got[i][1] in (f, "unknown") for i, _, f in rows)


def test_other_lines_are_passed_over(spark, model):
    lines = ["we licensed the dog", "my rights are reserved for you", "the Apache village", "plain words", "version 2.0"]
    assert [r for r in scan_licenses(documents(spark, [(1, "\n".join(lines), "s")]), model).collect() if r.family != "unknown"] == []
    odd = "Licensed under the Grumbly Frog License, version 9, with permission of the frog."
    got = scan_licenses(documents(spark, [(1, odd, "s")]), model).collect()
    assert all(r.family == "unknown" for r in got)


def test_given_table(spark, model):
    """Every line of the table with one of its notices, and no other."""
    df = spark.read.parquet(f"{SF}/documents.parquet")
    got = {(r.doc_id, r.paragraph): r.family for r in scan_licenses(df, model).collect() if r.family != "unknown"}
    signs = {"MIT License": "MIT", "Apache License": "Apache", "GNU General Public": "GPL", "CC BY-NC": "CC-BY-NC", "All rights reserved": "proprietary"}
    want = {}
    for d in given("documents"):
        for i, line in enumerate((d["text"] or "").split("\n")):
            for sign, family in signs.items():
                if sign in line and len(line) < 100:
                    want[d["doc_id"], i] = family
    assert got == want and want


def test_scores_equal_plain_ones(spark, model):
    line = "This work is licensed under the GNU General Public License, version 3."
    row = scan_licenses(documents(spark, [(1, line, "s")]), model).first()
    words = re.findall(r"[a-z0-9]+(?:[.+-][a-z0-9]+)*", line.lower())
    grams = {" ".join(words[i : i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1)}
    margins = list(model.intercepts)
    for g in grams & model.weights.keys():
        margins = [a + b for a, b in zip(margins, model.weights[g])]
    total = sum(math.exp(m) for m in margins)
    assert abs(row.probability - math.exp(max(margins)) / total) < 1e-9
    assert model.families[margins.index(max(margins))] == row.family == "GPL"


def test_odd_rows(spark, model):
    long = ("word " * 5000 + "\n") * 5 + "Released under the MIT License."
    rows = [*ODD_ROWS, (50, long, "s"), (50, long, "s"), (None, "All rights reserved.", None)]
    got = sorted((r.doc_id or 0, r.paragraph, r.family) for r in scan_licenses(widened(documents(spark, rows)), model).collect())
    assert got == [(0, 0, "proprietary"), (50, 5, "MIT"), (50, 5, "MIT")]
    assert scan_licenses(documents(spark, []), model).collect() == []
