"""Compare a query with its checking SQL (used by the tests and from the shell)."""

from __future__ import annotations

import glob
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET threads = 4")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _value(v):
    if isinstance(v, float):
        return None if math.isnan(v) else (0.0 if v == 0 else v)
    return v


def _canon(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(
        (tuple(_value(r[i]) for i in order) for r in rows), key=lambda t: tuple(str(x) for x in t)
    )


def compare(df, con, sql: str) -> str | None:
    """None when equal, else what differs."""
    got_cols, got = _canon(df.columns, [tuple(r) for r in df.collect()])
    res = con.execute(sql)
    want_cols, want = _canon([d[0] for d in res.description], res.fetchall())
    if got_cols != want_cols:
        return f"columns {got_cols} != {want_cols}"
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}; first {got[:2]} / {want[:2]}"
    for a, b in zip(got, want):
        if a != b:
            return f"first difference {a} != {b}"
        if [type(x) for x in a] != [type(x) for x in b]:
            return f"types {a} != {b}"
    return None


def main() -> None:
    from tarmac.session import build_session
    import __spark_entry__ as entry

    sf_dir = sys.argv[1]
    wanted = sys.argv[2:]
    spark = build_session(
        master="local[8]", spark_sql_shuffle_partitions="8", spark_ui_enabled="false",
        spark_driver_memory="12g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    queries, sql = entry.queries(), entry.oracle_sql()
    for name in queries:
        if wanted and not any(w in name for w in wanted):
            continue
        start = time.time()
        try:
            df = queries[name](spark, sf_dir)
            if name in sql:
                verdict = compare(df, con, sql[name]) or "ok"
            else:
                verdict = f"rows {len(df.collect())}"
        except Exception as e:  # report and go on
            verdict = f"ERROR {type(e).__name__}: {str(e)[:600]}"
        print(f"{name:34s} {time.time() - start:6.2f}s {verdict[:900]}", flush=True)


if __name__ == "__main__":
    main()
