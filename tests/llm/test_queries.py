"""The registered queries of the subpackage, and those with SQL beside it."""

import inspect

import pytest

import __spark_entry__ as entry
from citelake.llm.queries import ORACLE, QUERIES
from tests.compare import connect, differences
from tests.llm.tables import SF


def test_all_are_registered():
    assert {n.split("_")[0] for n in QUERIES} == {f"op{i}" for i in range(1, 11)}
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries())
    assert set(ORACLE) <= set(QUERIES) and set(ORACLE) <= set(entry.oracle_sql())
    assert all(list(inspect.signature(q).parameters) == ["spark", "sf_dir"] for q in QUERIES.values())


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_against_sql(spark, name):
    diff, _, n = differences(spark, connect(SF), SF, name)
    assert diff is None, diff
    assert n > 0
