"""Run registered queries in Spark and DuckDB and compare whole results.

Usage: python tests/compare.py [scale folder] [name ...]
"""

import datetime
import decimal
import glob
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def plain(v):
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, float) and math.isnan(v):
        return "nan"
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    return v


def normal(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def duck(folder):
    con = duckdb.connect()
    for f in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(f)[:-8]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{f}'")
    return con


def kinds(types):
    """Type families as far as both engines can agree on them."""
    out = []
    for t in types:
        t = str(t).lower()
        for family, names in {"int": ("bigint", "int", "smallint", "integer", "hugeint"), "double": ("double", "float"),
                              "string": ("string", "varchar")}.items():
            if t in names:
                t = family
        out.append(t)
    return out


def check(spark, con, name, fn, sql, folder):
    df = fn(spark, folder)
    got = [tuple(r) for r in df.collect()]
    if sql is None:
        assert got, f"{name}: no rows"
        return len(got)
    cur = con.execute(sql)
    cols = [d[0] for d in cur.description]
    want = cur.fetchall()
    assert sorted(df.columns) == sorted(cols), f"{name}: columns {sorted(df.columns)} vs {sorted(cols)}"
    st = dict(zip(df.columns, kinds([t for _, t in df.dtypes])))
    dt = dict(zip(cols, kinds([d[1] for d in cur.description])))
    bad = {c: (st[c], dt[c]) for c in cols if st[c] != dt[c]}
    a, b = normal(df.columns, got), normal(cols, want)
    assert len(a) == len(b), f"{name}: {len(a)} rows vs {len(b)}"
    diff = [(x, y) for x, y in zip(a, b) if repr(x) != repr(y)]
    assert not diff, f"{name}: {len(diff)} of {len(a)} rows differ, first {diff[0]}"
    assert not bad, f"{name}: types {bad}"
    assert a, f"{name}: no rows"
    return len(a)


if __name__ == "__main__":
    from beamwright.queries import QUERIES, SQL
    from beamwright.session import local_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark, con = local_session(), duck(folder)
    failed = []
    for name in sys.argv[2:] or QUERIES:
        start = time.time()
        try:
            n = check(spark, con, name, QUERIES[name], SQL.get(name), folder)
            print(f"ok   {name} rows={n} {time.time() - start:.1f}s{'' if name in SQL else ' (rows only)'}", flush=True)
        except Exception as e:
            failed.append(name)
            print(f"FAIL {name}: {str(e)[:700]}", flush=True)
    print(f"{len(failed)} failed: {failed}")
