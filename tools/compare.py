"""Run registered queries beside their SQL twins and report differences.

    python tools/compare.py [--sf DIR] [name ...]
"""

from __future__ import annotations

import argparse
import math
import os
import sys
import time

import duckdb
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from adledger.plans.catalog import all_oracles, all_queries  # noqa: E402
from adledger.session import get_session  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def cell(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, float):
        return float(f"{v:.9g}")
    return v


def normal(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(cell(r[i]) for i in order) for r in rows), key=repr)


def compare(spark, con, folder, name, query, sql):
    """(error or None, rows, seconds of the Spark side)."""
    start = time.time()
    df = query(spark, folder)
    rows = [tuple(r) for r in df.collect()]
    took = time.time() - start
    if sql is None:
        return None, len(rows), took
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    expected = cur.fetchall()
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} != {sorted(names)}", len(rows), took
    got, want = normal(df.columns, rows), normal(names, expected)
    if got != want:
        diff = [(g, w) for g, w in zip(got, want) if g != w]
        return f"{len(got)} vs {len(want)} rows, {len(diff)} differ, first: {diff[:2]}", len(rows), took
    types = [(g, w) for g, w in zip(got[0], want[0]) if type(g) is not type(w)] if got else []
    if types:
        return f"types differ: {types}", len(rows), took
    return None, len(rows), took


def main():
    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="/root/testdata/sf0.01")
    parser.add_argument("--plain", action="store_true", help="a session with Spark's defaults")
    parser.add_argument("names", nargs="*")
    args = parser.parse_args()
    if args.plain:
        spark = SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false").getOrCreate()
    else:
        spark = get_session("compare", "local[8]", **{
            "spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g",
            "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con, oracles, bad = connect(args.sf), all_oracles(), 0
    for name, query in all_queries().items():
        if args.names and name not in args.names:
            continue
        try:
            error, n, took = compare(spark, con, args.sf, name, query, oracles.get(name))
        except Exception as e:
            error, n, took = f"{type(e).__name__}: {str(e)[:600]}", -1, 0.0
        bad += error is not None
        kind = "sql" if name in oracles else "rows"
        print(f"{'FAIL' if error else 'ok  '} {kind:4} {name:28} {n:7} rows {took:6.2f}s {error or ''}", flush=True)
    print(f"{bad} failed")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
