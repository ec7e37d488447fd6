"""Run queries in Spark and their SQL check in DuckDB; report differences.

Usage: python -m tests.compare [key ...]   (folder: SF_DIR)
"""

from __future__ import annotations

import glob
import math
import os
import sys
import time
from collections import Counter

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
import __spark_entry__ as entry  # noqa: E402
from stallkeeper.session import build_session  # noqa: E402


def _plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    if isinstance(v, int) and not isinstance(v, bool):
        return repr(v)
    return str(v)


def _table(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], Counter(tuple(_plain(r[i]) for i in order) for r in rows)


_KIND = {"BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string", "BOOLEAN": "boolean",
         "TIMESTAMP": "timestamp", "DATE": "date"}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        con.execute(f"create view {os.path.basename(path)[:-8]} as select * from '{path}'")
    return con


def difference(spark, con, sf_dir: str, key: str, sql: str) -> str:
    """Empty when both engines agree exactly."""
    df = entry.queries()[key](spark, sf_dir)
    names, got = _table(df.columns, [tuple(r) for r in df.collect()])
    rel = con.execute(sql)
    want_names, want = _table([d[0] for d in rel.description], rel.fetchall())
    if names != want_names:
        return f"columns {names} vs {want_names}"
    kinds = {d[0]: _KIND.get(str(d[1]).upper(), str(d[1])) for d in rel.description}
    off = {c: (t, kinds[c]) for c, t in df.dtypes if t.removesuffix("_ntz") != kinds[c]}
    if off:
        return f"types {off}"
    if got != want:
        a, b = list((got - want).elements()), list((want - got).elements())
        return f"{len(a)} only in Spark, {len(b)} only in SQL\n   {sorted(a)[:2]}\n   {sorted(b)[:2]}"
    return "" if got else "EMPTY"


def main() -> None:
    sf_dir = os.environ.get("SF_DIR", "/root/testdata/sf0.01")
    spark, con = build_session(cores="8"), connect(sf_dir)
    spark.sparkContext.setLogLevel("OFF")
    oracles = entry.oracle_sql()
    keys = sys.argv[1:] or list(entry.queries())
    bad = 0
    for key in keys:
        start = time.time()
        if key not in oracles:
            print(f"NO SQL  {key}", flush=True)
            continue
        try:
            diff = difference(spark, con, sf_dir, key, oracles[key])
        except Exception as e:  # report and go on
            diff = f"ERROR {type(e).__name__} {str(e)[:700]}"
        bad += diff not in ("", "EMPTY")
        print(f"{'ok' if not diff else diff if diff == 'EMPTY' else 'DIFF'}  {key}  {time.time() - start:.1f}s"
              + (f"\n   {diff}" if diff not in ("", "EMPTY") else ""), flush=True)
    print(f"{len(keys)} queries, {bad} differ")


if __name__ == "__main__":
    main()
