"""Run registered queries against DuckDB on the same tables: ``python tests/crosscheck.py [sf_dir] [queries or modules...]``."""

from __future__ import annotations

import datetime as dt
import decimal
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _plain(v):
    if isinstance(v, (float, decimal.Decimal)):
        return f"f{float(v):.9g}"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, int):
        return f"i{v}"
    if isinstance(v, dt.datetime):
        return f"t{v.replace(tzinfo=None).isoformat()}"
    if isinstance(v, dt.date):
        return f"d{v.isoformat()}"
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(_plain(x) for x in v) + "]"
    return repr(v)


def normal(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(_plain(r[i]) for i in order) for r in rows)


def compare(df, con, sql: str) -> str | None:
    """None when equal, else what differs."""
    got_cols, got = normal(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(sql)
    want_cols, want = normal([c[0] for c in cur.description], cur.fetchall())
    if got_cols != want_cols:
        return f"columns {got_cols} != {want_cols}"
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)}"
    bad = [(g, w) for g, w in zip(got, want) if g != w]
    return f"{len(bad)} of {len(got)} rows differ, first: {bad[0]}" if bad else (None if got else "no rows")


def main(argv):
    sf = argv[0] if argv else "/root/testdata/sf0.01"
    from kpimill.plans.catalog import ORACLES, QUERIES
    from kpimill.session import get_session

    spark = get_session("crosscheck", "local[8]", {"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf)
    failed = []
    picked = [n for n in QUERIES if not argv[1:] or n in argv[1:] or QUERIES[n].__module__.split(".")[-1] in argv[1:]]
    for name in picked:
        t = time.time()
        try:
            df = QUERIES[name](spark, sf)
            if name in ORACLES:
                problem = compare(df, con, ORACLES[name])
                state = "ok" if problem is None else f"FAIL {problem}"
            else:
                state = f"rows-only {df.count()}"
        except Exception as e:  # report and go on with the next query
            state = f"FAIL {type(e).__name__}: {str(e)[:700]}"
        if state.startswith("FAIL"):
            failed.append(name)
        print(f"{name:32s} {time.time() - t:6.2f}s {state}", flush=True)
    print(f"{len(failed)} failed: {failed}")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
