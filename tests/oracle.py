"""Side-by-side check of a Spark query against its DuckDB oracle: row count, column names
(sorted) and an order-insensitive hash of the values."""

from __future__ import annotations

import datetime
import decimal
import hashlib
import math

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _canon(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, float) and math.isnan(v):
        return "NULL"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, (int, float, decimal.Decimal)):
        f = float(v)
        if math.isinf(f):
            return "inf" if f > 0 else "-inf"
        return str(int(f)) if f == int(f) and abs(f) < 2**53 else repr(f)
    if isinstance(v, (datetime.datetime, datetime.date)):
        return v.isoformat()
    try:  # numpy scalars
        import numpy as np

        if isinstance(v, np.generic):
            return _canon(v.item())
    except ImportError:
        pass
    return str(v)


def _rows(columns, tuples):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted("\x1f".join(_canon(t[i]) for i in order) for t in tuples)


def compare(spark_df, con, sql: str) -> dict:
    s_cols = spark_df.columns
    s_rows = _rows(s_cols, [tuple(r) for r in spark_df.collect()])
    rel = con.execute(sql)
    d_cols = [d[0] for d in rel.description]
    d_rows = _rows(d_cols, rel.fetchall())
    h = lambda rows: hashlib.sha256("\n".join(rows).encode()).hexdigest()
    out = {
        "rows_spark": len(s_rows),
        "rows_oracle": len(d_rows),
        "schema_match": sorted(s_cols) == sorted(d_cols),
        "hash_match": h(s_rows) == h(d_rows),
    }
    if not out["schema_match"]:
        out["cols"] = (sorted(s_cols), sorted(d_cols))
    if not out["hash_match"]:
        sd, dd = set(s_rows), set(d_rows)
        out["only_spark"] = sorted(sd - dd)[:3]
        out["only_oracle"] = sorted(dd - sd)[:3]
    out["ok"] = out["schema_match"] and out["hash_match"] and len(s_rows) == len(d_rows)
    return out
