"""Runs queries beside their SQL: python tests/compare_sql.py [-d DIR] [NAME...]"""

import math
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


def _plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else f"{v:.9g}"
    return str(v)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), Counter(tuple(_plain(r[i]) for i in order) for r in rows)


def duck(data):
    con = duckdb.connect()
    con.execute("set timezone='UTC'")
    for p in Path(data).glob("*.parquet"):
        src = f"{p}/*.parquet" if p.is_dir() else str(p)
        con.execute(f"create view {p.stem} as select * from '{src}'")
    return con


def compare(spark, con, data, name, query, sql):
    """(same, text) of one query against its SQL."""
    t = time.time()
    df = query(spark, data)
    got = rows_of(df.columns, df.collect())
    took = time.time() - t
    if sql is None:
        return True, f"{name}: {sum(got[1].values())} rows, no SQL, {took:.1f} s"
    cur = con.execute(sql)
    want = rows_of([d[0] for d in cur.description], cur.fetchall())
    if got == want:
        return True, f"{name}: {sum(got[1].values())} rows equal, {took:.1f} s"
    more, less = got[1] - want[1], want[1] - got[1]
    return False, f"{name}: DIFFERENT {got[0]} {want[0]} spark {sum(got[1].values())} sql {sum(want[1].values())}; only spark {list(more)[:3]}; only sql {list(less)[:3]}"


if __name__ == "__main__":
    from conftest import make_session

    import __spark_entry__ as e

    args = sys.argv[1:]
    data = "/root/testdata/sf0.01"
    if args[:1] == ["-d"]:
        data, args = args[1], args[2:]
    spark, con, sqls = make_session(), duck(data), e.oracle_sql()
    bad = 0
    for name, query in e.queries().items():
        if not args or any(name.startswith(a) for a in args):
            try:
                same, text = compare(spark, con, data, name, query, sqls.get(name))
            except Exception as x:  # noqa: BLE001
                same, text = False, f"{name}: {type(x).__name__} {str(x)[:1500]}"
            bad += not same
            print(text, flush=True)
    sys.exit(bad > 0)
