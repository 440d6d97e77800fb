"""Run registered queries next to their SQL on DuckDB and compare whole results.

    python tools/check.py [--sf /root/testdata/sf0.01] [name ...]
"""

from __future__ import annotations

import argparse
import datetime
import decimal
import math
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import duckdb
from pyspark.sql import SparkSession

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()


def session() -> SparkSession:
    spark = (SparkSession.builder.master("local[8]").appName("cardloom-check")
             .config("spark.sql.shuffle.partitions", "8").config("spark.ui.enabled", "false")
             .config("spark.driver.memory", "12g").config("spark.sql.session.timeZone", "UTC")
             .config("spark.ui.showConsoleProgress", "false").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def plain(v):
    """A comparable form: numbers by value, everything else as it is."""
    if isinstance(v, bool) or v is None:
        return v
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        return int(v) if v.is_integer() and abs(v) < 2 ** 53 else v
    if isinstance(v, datetime.datetime) and v.time() == datetime.time():
        return v.date()
    if isinstance(v, (list, tuple)):
        return [plain(x) for x in v]
    return v


def normal(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(([plain(r[i]) for i in order] for r in rows), key=repr)


def compare(got, want) -> str:
    (gc, gr), (wc, wr) = normal(*got), normal(*want)
    if gc != wc:
        return f"columns differ: {sorted(set(gc) ^ set(wc))}"
    if len(gr) != len(wr):
        return f"rows {len(gr)} != {len(wr)}"
    bad = [(a, b) for a, b in zip(gr, wr) if a != b]
    if bad:
        a, b = bad[0]
        cells = [(c, x, y) for c, x, y in zip(gc, a, b) if x != y][:4]
        return f"{len(bad)} rows differ, first: {cells}"
    return ""


def main() -> int:
    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="/root/testdata/sf0.01")
    parser.add_argument("names", nargs="*")
    args = parser.parse_args()
    from cardloom.catalog import load
    spark, con = session(), connect(args.sf)
    failed = 0
    for name, q in load().items():
        if args.names and not any(n in name for n in args.names):
            continue
        t = time.time()
        try:
            df = q.run(spark, args.sf)
            rows = [tuple(r) for r in df.collect()]
            took = time.time() - t
            problem = ""
            if q.sql:
                cur = con.execute(q.sql)
                problem = compare((df.columns, rows), ([c[0] for c in cur.description], cur.fetchall()))
        except Exception as e:  # a broken query must not hide the others
            took, rows, problem = time.time() - t, [], f"{type(e).__name__}: {str(e)[:600]}"
        failed += bool(problem)
        print(f"{'FAIL' if problem else 'ok  '} {'sql ' if q.sql else 'rows'} {took:6.2f}s {len(rows):7d} {name} {problem}", flush=True)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(main() and 1)
