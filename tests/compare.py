"""Run registered queries and their SQL side by side: ``python -m tests.compare SF [name …]``."""

import math
import sys
import time

import duckdb

from __spark_entry__ import oracle_sql, queries

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir):
    db = duckdb.connect()
    for name in TABLES:
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return db


def _key(row):
    return tuple((v is None, str(v)) for v in row)


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    clean = lambda v: None if isinstance(v, float) and math.isnan(v) else v
    return sorted((tuple(clean(r[i]) for i in order) for r in rows), key=_key)


def differences(spark, db, sf_dir, name):
    """None when equal, else a short account; also the Spark time."""
    start = time.time()
    df = queries()[name](spark, sf_dir)
    got = [tuple(r) for r in df.collect()]
    took = time.time() - start
    cursor = db.execute(oracle_sql()[name])
    columns = [c[0] for c in cursor.description]
    want = [tuple(r) for r in cursor.fetchall()]
    if sorted(columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(columns)}", took, len(got)
    a, b = _rows(df.columns, got), _rows(columns, want)
    if a != b:
        extra = [r for r in a if r not in set(b)][:3]
        missing = [r for r in b if r not in set(a)][:3]
        return f"{len(a)} rows vs {len(b)}; only here {extra}; only SQL {missing}", took, len(got)
    return None, took, len(got)


if __name__ == "__main__":
    from citelake.session import get_spark

    sf_dir = f"/root/testdata/{sys.argv[1]}"
    session = get_spark("compare", "local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.driver.memory": "12g"})
    session.sparkContext.setLogLevel("ERROR")
    base = connect(sf_dir)
    bad = 0
    for key in sys.argv[2:] or oracle_sql():
        try:
            diff, took, n = differences(session, base, sf_dir, key)
        except Exception as error:  # report and go on
            diff, took, n = f"{type(error).__name__}: {str(error)[:300]}", 0, -1
        bad += diff is not None
        print(f"{key:24} {n:8} rows {took:6.2f} s  {diff or 'ok'}", flush=True)
    sys.exit(bad > 0)
