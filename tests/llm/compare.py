"""Holds a registered query against its SQL on the same tables."""

import glob
import os

import duckdb


def tables(folder):
    db = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        db.sql(f"create view {name} as select * from '{path}{'/*.parquet' if os.path.isdir(path) else ''}'")
    return db


def check(spark, query, sql, folder):
    frame = query(spark, folder)
    want = tables(folder).sql(sql)
    names = sorted(frame.columns)
    assert sorted(want.columns) == names
    rows = sorted(tuple(r[n] for n in names) for r in frame.collect())
    assert rows == sorted(tuple(dict(zip(want.columns, r, strict=True))[n] for n in names) for r in want.fetchall())
    return rows
