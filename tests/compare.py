"""Spark's rows against DuckDB's, without regard to order."""

import os

import duckdb
import pandas as pd

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    c = duckdb.connect()
    for t in TABLES:
        p = f"{folder}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{p if os.path.isfile(p) else p + '/*.parquet'}'")
    return c


def canonical(df: pd.DataFrame) -> pd.DataFrame:
    df = df[sorted(df.columns)].copy()
    for c in df.columns:
        if str(df[c].dtype).startswith("float"):
            df[c] = df[c].round(6).map(lambda x: None if pd.isna(x) else repr(float(x) + 0.0))
        else:
            df[c] = df[c].map(lambda x: None if x is None or x is pd.NA or (isinstance(x, float) and pd.isna(x)) or x is pd.NaT else str(x))
    return df.sort_values(list(df.columns)).reset_index(drop=True)


def check(spark, query, sql: str, folder: str) -> None:
    got, want = query(spark, folder).toPandas(), duck(folder).sql(sql).df()
    assert sorted(got.columns) == sorted(want.columns)
    a, b = canonical(got), canonical(want)
    if not a.equals(b):
        odd = a.merge(b, how="outer", indicator=True)
        raise AssertionError(f"{len(a)} and {len(b)} rows; different:\n{odd[odd['_merge'] != 'both'].head(10)}")
