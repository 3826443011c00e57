"""Compare registered queries with their SQL on the given tables.

    python tests/oracle_check.py [data folder] [query ...]
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        if Path(f"{sf_dir}/{t}.parquet").exists():
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _key(row: tuple) -> tuple:
    return tuple((v is not None, str(type(v)), str(v)) for v in row)


def _same(a, b) -> bool:
    if isinstance(a, float) and isinstance(b, float):
        return math.isclose(a, b, rel_tol=1e-12, abs_tol=1e-9)
    return type(a) is type(b) and a == b


def compare(spark, con, name: str, build, sql: str, sf_dir: str) -> str:
    """'' when both sides agree on columns and rows, else what differs."""
    df = build(spark, sf_dir)
    names = sorted(df.columns)
    ours = sorted((tuple(r[n] for n in names) for r in df.collect()), key=_key)
    cur = con.execute(sql)
    theirs_names = [d[0] for d in cur.description]
    if sorted(theirs_names) != names:
        return f"columns {names} != {sorted(theirs_names)}"
    at = [theirs_names.index(n) for n in names]
    theirs = sorted((tuple(r[i] for i in at) for r in cur.fetchall()), key=_key)
    if len(ours) != len(theirs):
        return f"rows {len(ours)} != {len(theirs)}"
    for a, b in zip(ours, theirs):
        if not all(_same(x, y) for x, y in zip(a, b)):
            return f"{names}\n  ours   {a}\n  theirs {b}"
    return ""


def main() -> int:
    from tests.conftest import build_session

    import __spark_entry__ as entry

    args = sys.argv[1:]
    sf_dir = args[0] if args else "/root/testdata/sf0.01"
    only = set(args[1:])
    spark, con = build_session(), connect(sf_dir)
    queries, oracle = entry.queries(), entry.oracle_sql()
    print("without SQL:", sorted(set(queries) - set(oracle)), "unknown:", sorted(set(oracle) - set(queries)))
    bad = 0
    for name, build in queries.items():
        if (only and name not in only) or name not in oracle:
            continue
        t = time.time()
        try:
            diff = compare(spark, con, name, build, oracle[name], sf_dir)
        except Exception as e:  # report and go on with the next query
            diff = f"{type(e).__name__}: {str(e)[:800]}"
        bad += bool(diff)
        print(f"{'FAIL' if diff else 'ok  '} {name} {time.time() - t:.1f}s {diff}", flush=True)
    print(f"{bad} differ")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
