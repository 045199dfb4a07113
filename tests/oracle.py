"""Run a query in Spark and its SQL in DuckDB and compare rows without order."""

import datetime as dt
import os

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(v):
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, float):
        return float(f"{v:.12g}")
    return v if not isinstance(v, dt.date) else v.isoformat()


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda k: names[k])
    return sorted([tuple(plain(r[k]) for k in order) for r in rows], key=repr)


def compare(spark, query, sql, sf_dir):
    df = query(spark, sf_dir)
    mine = rows_of(df.columns, df.collect())
    con = duckdb.connect()
    for t in TABLES:
        if os.path.exists(f"{sf_dir}/{t}.parquet"):
            con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    theirs = rows_of(names, cur.fetchall())
    assert sorted(df.columns) == sorted(names), (sorted(df.columns), sorted(names))
    assert len(mine) == len(theirs), (len(mine), len(theirs))
    different = [(a, b) for a, b in zip(mine, theirs) if a != b]
    assert not different, different[:3]
    return len(mine)
