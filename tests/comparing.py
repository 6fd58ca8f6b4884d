"""Spark's rows against DuckDB's."""

from collections import Counter
from pathlib import Path

import duckdb


def duck(sf_dir):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for p in Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM read_parquet('{p}')")
    return con


def counted(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(round(r[i], 6) if isinstance(r[i], float) else r[i] for i in order) for r in rows)


def same(df, con, sql):
    rows = [tuple(r) for r in df.collect()]
    cur = con.execute(sql)
    names = [c[0] for c in cur.description]
    assert sorted(df.columns) == sorted(names)
    assert counted(rows, df.columns) == counted(cur.fetchall(), names)
