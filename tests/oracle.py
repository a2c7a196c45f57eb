"""Rows of a Spark result and of DuckDB SQL over the same tables, made comparable."""

import os

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def plain(v):
    if isinstance(v, float):
        return None if v != v else round(v, 6)
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    return v


def rows_of(arrow):
    names = sorted(arrow.column_names)
    return names, sorted((tuple(plain(v) for v in r) for r in zip(*(arrow[n].to_pylist() for n in names), strict=True)), key=repr)


def duck(sql, sf=SF):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    return rows_of(con.sql(sql).to_arrow_table())
