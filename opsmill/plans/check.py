"""Run queries next to their oracles and compare row for row.

    python -m opsmill.plans.check [sf_dir] [name prefix ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

from opsmill.plans import catalogue, fixtures
from opsmill.session import build_session


def _plain(v):
    if isinstance(v, bool) or v is None:
        return repr(v)
    if isinstance(v, float):
        return "None" if math.isnan(v) else f"f{v:.6f}"
    return f"{type(v).__name__[0]}{v}"


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_plain(r[i]) for i in order) for r in rows)


def compare(spark, con, name: str, root: str):
    start = time.time()
    df = catalogue.QUERIES_BY_NAME[name](spark, root)
    got = rows_of(df.columns, df.collect())
    spent = time.time() - start
    sql = catalogue.ORACLES.get(name)
    if sql is None:
        return f"{name}: rows {len(got)} (no oracle) {spent:.1f}s", True
    start = time.time()
    cur = con.execute(sql)
    columns = [d[0] for d in cur.description]
    want = rows_of(columns, cur.fetchall())
    duck = time.time() - start
    ok = sorted(columns) == sorted(df.columns) and got == want
    text = f"{name}: {'ok' if ok else 'DIFFERENT'} rows {len(got)}/{len(want)} spark {spent:.1f}s duckdb {duck:.1f}s"
    if not ok:
        text += f"\n  columns {sorted(df.columns)}\n  oracle  {sorted(columns)}"
        a, b = set(got) - set(want), set(want) - set(got)
        text += f"\n  only spark {len(a)}: {sorted(a)[:3]}\n  only oracle {len(b)}: {sorted(b)[:3]}"
    return text, ok


def main(argv):
    import duckdb

    root = argv[0] if argv else "/root/testdata/sf0.01"
    prefixes = tuple(argv[1:])
    spark = build_session("check", f"local[{os.environ.get('CHECK_CPUS', '8')}]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "12g"})
    spark.sparkContext.setLogLevel("ERROR")
    con = duckdb.connect()
    for t in fixtures.BASE_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{root}/{t}.parquet'")
    bad = []
    for name in catalogue.QUERIES_BY_NAME:
        if prefixes and not name.startswith(prefixes):
            continue
        try:
            text, ok = compare(spark, con, name, root)
        except Exception as e:  # report and go on with the next query
            text, ok = f"{name}: FAILED {type(e).__name__} {str(e)[:1500]}", False
        print(text, flush=True)
        if not ok:
            bad.append(name)
    print("different or failed:", bad)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
