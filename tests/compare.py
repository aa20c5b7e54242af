"""Compare registered queries with their SQL on DuckDB: ``python tests/compare.py SF_DIR [name ...]``."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _cell(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v:.9g}")
    return v


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted((tuple(_cell(r[i]) for i in order) for r in rows), key=repr)


def compare(spark, con, name, fn, sql, sf_dir):
    """None when equal, else a message."""
    df = fn(spark, sf_dir)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if sql is None:
        return None if got[1] else "no rows"
    res = con.execute(sql)
    want = rows_of([d[0] for d in res.description], res.fetchall())
    if got[0] != want[0]:
        return f"columns {got[0]} vs {want[0]}"
    if not want[1]:
        return "the check is empty"
    if got[1] == want[1]:
        return None
    a, b = set(map(repr, got[1])), set(map(repr, want[1]))
    return f"rows {len(got[1])} vs {len(want[1])}; only spark {sorted(a - b)[:3]}; only sql {sorted(b - a)[:3]}"


def main() -> int:
    from __spark_entry__ import oracle_sql, queries
    from crawlframe.session import build_session

    sf_dir, names = sys.argv[1], sys.argv[2:]
    spark = build_session(master="local[8]", **{"spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "8"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    sqls, bad = oracle_sql(), 0
    for name, fn in queries().items():
        if names and not any(n in name for n in names):
            continue
        start = time.time()
        try:
            message = compare(spark, con, name, fn, sqls.get(name), sf_dir)
        except Exception as e:  # noqa: BLE001
            message = f"{type(e).__name__}: {str(e)[:600]}"
        bad += message is not None
        print(f"{'ok  ' if message is None else 'FAIL'} {name} {time.time() - start:.1f}s {message or ''}", flush=True)
    print(f"{bad} failed")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
