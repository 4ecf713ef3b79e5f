"""Comparison of registered queries with DuckDB on the same tables."""

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def rows_of(df):
    df = df[sorted(df.columns)]
    return sorted(tuple(f"{x:.6f}" if isinstance(x, float) else str(x) for x in r) for r in df.itertuples(index=False))
