"""Holds registered queries against their SQL in DuckDB."""

import math
import os

import duckdb
import pandas as pd

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connection(sf: str):
    con = duckdb.connect()
    for t in TABLES:
        if os.path.exists(f"{sf}/{t}.parquet"):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return con


def _plain(v):
    """Values as they are whatever pandas makes of columns with nulls."""
    if v is None or v is pd.NA or isinstance(v, float) and math.isnan(v):
        return None
    return int(v) if isinstance(v, (float, int)) and not isinstance(v, bool) and float(v).is_integer() else v


def rows(frame) -> list[str]:
    columns = sorted(frame.columns)
    return sorted(str(tuple(map(_plain, r))) for r in frame[columns].astype(object).itertuples(index=False))


def compare(spark, con, sf: str, query, sql: str) -> None:
    got, want = query(spark, sf).toPandas(), con.sql(sql).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)
