"""Rows of a Spark result and of DuckDB SQL over the same tables, comparable."""

import os

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(repr([v if not isinstance(v, float) else round(v, 9) + 0.0 for v in (r[i] for i in order)]) for r in rows)


def by_duckdb(sql, sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        if os.path.exists(f"{sf_dir}/{t}.parquet"):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    got = con.execute(sql)
    return rows_of([d[0] for d in got.description], got.fetchall())


def by_spark(df):
    return rows_of(df.columns, [tuple(r) for r in df.collect()])
