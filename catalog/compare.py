"""Run queries next to their oracle statements and report differences.

    python -m catalog.compare [-s SF_DIR] [name ...]
"""

from __future__ import annotations

import argparse
import math
import time

import duckdb

BASE = ("region nation customer supplier part orders lineitem events documents embeddings pages "
        "benchmark labels conversations").split()


def connect(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in BASE:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else v + 0.0
    return list(v) if isinstance(v, (list, tuple)) else v


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda k: columns[k])
    return sorted(([_plain(r[k]) for k in order] for r in rows), key=lambda r: [(x is None, str(x)) for x in r])


def difference(spark_df, con, sql: str) -> str | None:
    """None if both sides agree in columns, types of values, rows and values."""
    cur = con.execute(sql)
    want_columns = [d[0] for d in cur.description]
    want = _rows(want_columns, cur.fetchall())
    got = _rows(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    if sorted(spark_df.columns) != sorted(want_columns):
        return f"columns {sorted(spark_df.columns)} vs {sorted(want_columns)}"
    if len(got) != len(want):
        return f"rows {len(got)} vs {len(want)}"
    bad = [(g, w) for g, w in zip(got, want)
           if g != w or [type(x) for x in g] != [type(x) for x in w]]
    if bad:
        names = sorted(spark_df.columns)
        g, w = bad[0]
        cells = {n: (a, b) for n, a, b in zip(names, g, w) if a != b or type(a) is not type(b)}
        return f"{len(bad)} of {len(got)} rows differ, first: {cells}"
    return "empty result" if not got else None


def main() -> None:
    ap = argparse.ArgumentParser()
    ap.add_argument("-s", "--sf-dir", default="/root/testdata/sf0.01")
    ap.add_argument("names", nargs="*")
    args = ap.parse_args()
    from bench import make_session
    from catalog.all_queries import ORACLES, QUERIES

    spark, con = make_session(), connect(args.sf_dir)
    failed = []
    for name in args.names or QUERIES:
        start = time.time()
        try:
            df = QUERIES[name](spark, args.sf_dir)
            found = difference(df, con, ORACLES[name]) if name in ORACLES else None
            note = "ok" if name in ORACLES else f"rows {df.count()}"
        except Exception as e:  # report and go on with the next query
            found = f"{type(e).__name__}: {str(e)[:600]}"
        if found:
            failed.append(name)
        print(f"{time.time() - start:7.2f}s {name:28s} {found or note}", flush=True)
    print(f"{len(failed)} failed: {failed}")


if __name__ == "__main__":
    main()
