"""Run registered queries on Spark and their SQL on DuckDB and compare the rows.

usage: python tests/compare.py [folder] [name prefix ...]
"""

import math
import os
import signal
import sys
import time

import duckdb

sys.path.insert(0, __file__.rsplit("/", 2)[0])

from rankline.plans import catalog  # noqa: E402
from rankline.plans.inputs import BASE  # noqa: E402
from rankline.session import build_session  # noqa: E402


def duck(folder):
    con = duckdb.connect()
    for name in BASE:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return float(f"{v:.9g}")
    if hasattr(v, "as_tuple"):
        return float(v)
    return v


def rows_of(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted([tuple(norm(r[i]) for i in order) for r in rows], key=lambda t: tuple((x is None, str(type(x)), str(x)) for x in t))


def compare(spark, con, name, build, sql, folder):
    """(ok, message, rows, seconds) of one query."""
    start = time.time()
    df = build(spark, folder)
    got = df.collect()
    took = time.time() - start
    if sql is None:
        return True, "rows only", len(got), took
    rel = con.execute(sql)
    cols = [d[0] for d in rel.description]
    want = rel.fetchall()
    if sorted(cols) != sorted(df.columns):
        return False, f"columns {sorted(df.columns)} != {sorted(cols)}", len(got), took
    types = {d[0]: str(d[1]) for d in rel.description}
    odd = []
    for f in df.schema.fields:
        s, d = f.dataType.simpleString(), types[f.name]
        same = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}.get(s)
        if same != d:
            odd.append(f"{f.name}:{s}/{d}")
    a, b = rows_of(df.columns, got), rows_of(cols, want)
    if a != b:
        only_a = [r for r in a if r not in set(b)][:3] if len(a) < 200000 else []
        only_b = [r for r in b if r not in set(a)][:3] if len(b) < 200000 else []
        return False, f"{len(a)} vs {len(b)} rows; spark {only_a} duck {only_b}", len(got), took
    return (not odd), ("types " + ",".join(odd) if odd else "ok"), len(got), took


def main():
    args = sys.argv[1:]
    folder = args[0] if args and "/" in args[0] else "/root/testdata/sf0.01"
    wanted = [a for a in args if "/" not in a]
    spark = build_session("compare", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(folder)
    bad = 0
    builds, sqls = catalog.queries(), catalog.checks()
    signal.signal(signal.SIGALRM, lambda *_: (_ for _ in ()).throw(TimeoutError('query too slow')))
    for name, build in builds.items():
        if wanted and not any(name.startswith(w) for w in wanted):
            continue
        signal.alarm(int(os.environ.get('QUERY_SECONDS', '60')))
        try:
            ok, msg, n, took = compare(spark, con, name, build, sqls.get(name), folder)
        except Exception as exc:  # noqa: BLE001
            ok, msg, n, took = False, f"{type(exc).__name__}: {str(exc)[:1500]}", -1, 0
        signal.alarm(0)
        bad += not ok
        print(f"{'ok ' if ok else 'BAD'} {name} rows={n} {took:.2f}s {'' if ok and msg == 'ok' else msg}", flush=True)
    print("bad:", bad)


if __name__ == "__main__":
    main()
