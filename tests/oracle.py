"""Run registered queries against their SQL on the test tables.

Usage: python tests/oracle.py [sf dir] [name or prefix ...]
"""

from __future__ import annotations

import sys
import time
from collections import Counter
from decimal import Decimal
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

import duckdb

import __spark_entry__ as contract

TABLES = """region nation customer supplier part orders lineitem events documents
embeddings pages benchmark labels conversations""".split()


def session():
    from pyspark.sql import SparkSession

    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def connect(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet')")
    return con


def _plain(value):
    if isinstance(value, bytearray):
        return bytes(value)
    if isinstance(value, Decimal):
        return float(value)
    if isinstance(value, float):
        return value + 0.0
    if isinstance(value, (list, tuple)):
        return tuple(_plain(v) for v in value)
    if isinstance(value, dict):
        return tuple(sorted((k, _plain(v)) for k, v in value.items()))
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


_SAME = {
    "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE",
    "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP", "date": "DATE", "binary": "BLOB",
}


def compare(spark, con, name: str, sf_dir: str) -> str:
    """Empty when equal, else what differs."""
    df = contract.queries()[name](spark, sf_dir)
    sql = contract.oracle_sql().get(name)
    got_rows = [tuple(r) for r in df.collect()]
    if sql is None:
        return "" if got_rows else "no rows"
    cursor = con.execute(sql)
    want_columns = [d[0] for d in cursor.description]
    want_types = {d[0]: str(d[1]) for d in cursor.description}
    want_rows = cursor.fetchall()
    if sorted(df.columns) != sorted(want_columns):
        return f"columns {sorted(df.columns)} != {sorted(want_columns)}"
    kinds = {c: _SAME.get(t, t) for c, t in df.dtypes}
    bad = {c: (k, want_types[c]) for c, k in kinds.items()
           if k in _SAME.values() and k != want_types[c]}
    if bad:
        return f"types {bad}"
    got, want = rows_of(df.columns, got_rows), rows_of(want_columns, want_rows)
    if got != want:
        return (f"rows {sum(got.values())} != {sum(want.values())}; columns {sorted(df.columns)}\n"
                f"  only ours: {list((got - want).items())[:3]}\n"
                f"  only SQL:  {list((want - got).items())[:3]}")
    return "" if got_rows else "no rows"


def main(sf_dir: str, wanted: list[str]) -> int:
    spark, con = session(), connect(sf_dir)
    failed = 0
    for name in contract.queries():
        if wanted and not any(name.startswith(w) for w in wanted):
            continue
        began = time.time()
        try:
            problem = compare(spark, con, name, sf_dir)
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        kind = "sql" if name in contract.oracle_sql() else "rows"
        print(f"{'FAIL' if problem else 'ok  '} {name} [{kind}] {time.time() - began:.1f}s {problem}", flush=True)
        failed += bool(problem)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    directory = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    sys.exit(1 if main(directory, sys.argv[2:]) else 0)
