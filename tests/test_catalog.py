"""Every registered query against its SQL, at the smallest scale."""

import os
import subprocess
import sys

import pytest

from __spark_entry__ import entry, oracle_sql
from catalog.queries import QUERIES
from tests.compare import connect, differences

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    return connect(SF)


def test_every_query_has_sql():
    assert set(QUERIES) <= set(oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, db, name):
    diff, _, n = differences(spark, db, SF, name)
    assert diff is None, diff
    assert n > 0


def test_entry(spark):
    assert entry(spark).count() > 0


ELSEWHERE = """
import importlib.util
spec = importlib.util.spec_from_file_location("__spark_entry__", {path!r})
module = importlib.util.module_from_spec(spec)
spec.loader.exec_module(module)
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[4]").getOrCreate()
for name in ("gzip_verify", "xml_trees"):
    assert module.queries()[name](spark, {sf!r}).count() > 0
"""


def test_tasks_need_no_copy_of_the_package(tmp_path):
    """Started from another folder, with nothing on the workers' import path."""
    import __spark_entry__

    script = tmp_path / "run.py"
    script.write_text(ELSEWHERE.format(path=os.path.abspath(__spark_entry__.__file__), sf=SF))
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    subprocess.run([sys.executable, str(script)], cwd=tmp_path, env=env, check=True, timeout=300)
