"""Compare a registered query with its SQL on the same Parquet tables."""

from __future__ import annotations

import datetime
import decimal
import math

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
SPARK_TO_SQL = {
    "bigint": "BIGINT", "int": "INTEGER", "smallint": "SMALLINT", "tinyint": "TINYINT", "double": "DOUBLE",
    "float": "FLOAT", "string": "VARCHAR", "date": "DATE", "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return 0.0 if v == 0 else float(f"{v:.12g}")
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, (datetime.datetime, datetime.date)):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return str([_norm(x) for x in v])
    return v


def _sorted(rows):
    return sorted(rows, key=lambda r: tuple((x is None, str(x)) for x in r))


def differences(df, con, sql: str) -> list[str]:
    """Human-readable differences; empty when rows, names, types and values agree."""
    out = []
    rel = con.sql(sql)
    names = sorted(df.columns)
    if names != sorted(rel.columns):
        return [f"columns {names} vs {sorted(rel.columns)}"]
    got_types = {n: SPARK_TO_SQL.get(t, t) for n, t in df.dtypes}
    want_types = {n: str(t) for n, t in zip(rel.columns, rel.types)}
    out += [f"type of {n}: {got_types[n]} vs {want_types[n]}" for n in names if got_types[n] != want_types[n]]
    got = _sorted([tuple(_norm(r[n]) for n in names) for r in df.collect()])
    pos = [rel.columns.index(n) for n in names]
    want = _sorted([tuple(_norm(r[i]) for i in pos) for r in rel.fetchall()])
    if len(got) != len(want):
        out.append(f"rows {len(got)} vs {len(want)}")
    bad = [(g, w) for g, w in zip(got, want) if g != w]
    if bad:
        out.append(f"{len(bad)} rows differ; {names}: {bad[0]}")
    return out
