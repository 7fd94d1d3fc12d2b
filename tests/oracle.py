"""A query against its SQL, as rows without order."""

import glob
import math
import os

import duckdb


def plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    if isinstance(value, float):
        return round(value, 9)
    return tuple(map(plain, value)) if isinstance(value, (list, tuple)) else value


def compare(spark, folder, query, sql):
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    df = query(spark, folder)
    columns = sorted(df.columns)
    mine = sorted(repr(tuple(map(plain, r))) for r in df.select(columns).collect())
    theirs = sorted(repr(tuple(map(plain, r))) for r in con.execute(f"SELECT {', '.join(columns)} FROM ({sql})").fetchall())
    assert mine == theirs
