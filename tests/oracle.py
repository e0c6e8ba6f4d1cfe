"""Run registered queries beside their SQL and compare the rows.

    python tests/oracle.py [sf_dir] [name ...]
"""

from __future__ import annotations

import glob
import math
import os
import sys
import tempfile
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as entry  # noqa: E402


def connect(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def _plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v:.12g}")
    if isinstance(v, (bytearray, memoryview)):
        return bytes(v)
    if isinstance(v, bool):
        return v
    if hasattr(v, "as_tuple"):
        return float(v)
    if hasattr(v, "tzinfo") and v.tzinfo is not None:
        return v.replace(tzinfo=None)
    return v


def compare(spark, con, name: str, sf_dir: str) -> str | None:
    """None when the rows agree, else what differs."""
    df = entry.queries()[name](spark, sf_dir)
    sql = entry.oracle_sql().get(name)
    cols = sorted(df.columns)
    got = [tuple(_plain(v) for v in r) for r in df.select(*[f"`{c}`" for c in cols]).collect()]
    if sql is None:
        return None if got else "no rows"
    ref = con.execute(sql)
    names = [d[0] for d in ref.description]
    if sorted(names) != cols:
        return f"columns {cols} against {sorted(names)}"
    at = [names.index(c) for c in cols]
    want = [tuple(_plain(r[i]) for i in at) for r in ref.fetchall()]
    if len(got) != len(want):
        return f"{len(got)} rows against {len(want)}"
    rank = lambda t: tuple((v is not None, str(v)) for v in t)
    got.sort(key=rank), want.sort(key=rank)
    for g, w in zip(got, want):
        if g != w:
            return f"row {g} against {w}"
    return None if got else "no rows"


def main() -> int:
    from pyspark.sql import SparkSession

    args = sys.argv[1:]
    sf_dir = args.pop(0) if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    spark = (
        SparkSession.builder.master("local[8]").config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", "8").config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    if not spark.conf.get("spark.checkpoint.dir", None):
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="keyloom-ckpt-"))
    con, bad = connect(sf_dir), 0
    for name in args or entry.queries():
        t0 = time.time()
        try:
            problem = compare(spark, con, name, sf_dir)
        except Exception as e:  # noqa: BLE001
            problem = f"{type(e).__name__}: {str(e)[:600]}"
        bad += problem is not None
        print(f"{'ok  ' if problem is None else 'BAD '} {name} {time.time() - t0:.1f}s {problem or ''}", flush=True)
    print(f"{bad} differ")
    return 1 if bad else 0


if __name__ == "__main__":
    raise SystemExit(main())
