"""Compare a query with its SQL."""

import glob
import os

import duckdb


def connect(folder):
    connection = duckdb.connect()
    connection.execute("set timezone = 'UTC'")
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path)[:-8]
        files = f"{path}/*.parquet" if os.path.isdir(path) else path
        connection.execute(f"create view {name} as select * from read_parquet('{files}')")
    return connection


def tidy(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    cell = lambda v: f"{v:.9g}" if isinstance(v, float) else str(v)
    return [columns[i] for i in order], sorted(tuple(cell(r[i]) for i in order) for r in rows)


def both(spark, folder, query, sql):
    df = query(spark, folder)
    mine = tidy([tuple(r) for r in df.collect()], df.columns)
    cursor = connect(folder).execute(sql)
    return mine, tidy(cursor.fetchall(), [c[0] for c in cursor.description])
