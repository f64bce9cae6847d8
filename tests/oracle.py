"""Rows of a Spark result and of its SQL, brought to one form."""

import os

import duckdb
import pandas as pd


def connect(folder):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for f in os.listdir(folder):
        con.execute(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{folder}/{f}'")
    return con


def cell(x):
    if x is None or x is pd.NaT or x is pd.NA or isinstance(x, float) and x != x:
        return "null"
    number = isinstance(x, (int, float)) and not isinstance(x, bool)  # a column of whole numbers with nulls comes as floats
    return repr(round(float(x), 5)) if number else str(x).replace("+00:00", "")


def rows(df):
    df = df[sorted(df.columns)]
    return sorted(tuple(map(cell, r)) for r in df.astype(object).itertuples(index=False))
