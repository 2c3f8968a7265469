"""Run a registered query and its oracle on the same folder and compare the rows."""

from __future__ import annotations

import glob
import math
import os

import duckdb


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for f in sorted(glob.glob(f"{folder}/*.parquet")):
        name = os.path.basename(f).rsplit(".", 1)[0]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{f}'")
    return con


def _cell(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return (0, "")
    if isinstance(v, bool):
        return (1, str(v))
    if isinstance(v, (int, float)):
        return (2, float(v))
    return (3, str(v))


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def spark_rows(df):
    return rows_of(df.columns, [tuple(r) for r in df.collect()])


def duck_rows(con, sql):
    cur = con.execute(sql)
    return rows_of([d[0] for d in cur.description], cur.fetchall())


def difference(df, con, sql):
    """Empty text when both sides agree exactly."""
    sc, sr = spark_rows(df)
    dc, dr = duck_rows(con, sql)
    if sc != dc:
        return f"columns {sc} != {dc}"
    if len(sr) != len(dr):
        return f"rows {len(sr)} != {len(dr)}"
    for a, b in zip(sr, dr):
        if a != b:
            bad = [(c, x, y) for c, x, y in zip(sc, a, b) if x != y]
            return f"{len([1 for p, q in zip(sr, dr) if p != q])} rows differ, first: {bad}"
    return ""


def plan_text(df):
    """The formatted physical plan, with untruncated scan details."""
    jvm = df.sparkSession.sparkContext._jvm
    return jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
