"""Comparing Spark results with DuckDB results as bags of rows."""

import math

import duckdb


def duck(folder, tables):
    con = duckdb.connect()
    for table in tables:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 9)
    return value


def bag(rows):
    return sorted((tuple(_plain(v) for v in row) for row in rows), key=repr)


def spark_bag(df):
    columns = sorted(df.columns)
    return columns, bag(tuple(r) for r in df.select(*[f"`{c}`" for c in columns]).collect())


def duck_bag(con, sql):
    result = con.execute(f"SELECT * FROM ({sql})")
    names = [d[0] for d in result.description]
    order = sorted(range(len(names)), key=names.__getitem__)
    return [names[i] for i in order], bag(tuple(r[i] for i in order) for r in result.fetchall())
