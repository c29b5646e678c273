"""Compare a Spark result with DuckDB SQL over the same parquet tables."""

from __future__ import annotations

import math

import duckdb
import pandas as pd

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str, sql: str) -> pd.DataFrame:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con.execute(sql).fetchdf()


def _norm(v):
    if v is None or v is pd.NA:  # a null of a nullable column
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 9)
    if isinstance(v, pd.Timestamp):
        return v.to_pydatetime().replace(tzinfo=None)
    if hasattr(v, "item"):
        return _norm(v.item())
    try:
        from decimal import Decimal
        if isinstance(v, Decimal):
            return round(float(v), 9)
    except Exception:
        pass
    return v


def rows(pdf: pd.DataFrame) -> list[tuple]:
    cols = sorted(pdf.columns)
    out = []
    for rec in pdf[cols].itertuples(index=False, name=None):
        out.append(tuple(_norm(v) for v in rec))
    return sorted(out, key=lambda r: tuple((x is None, str(type(x)), x if x is not None else 0) for x in r))


def compare(spark_df, sf_dir: str, sql: str) -> tuple[bool, str]:
    s = spark_df.toPandas()
    d = duck(sf_dir, sql)
    if sorted(s.columns) != sorted(d.columns):
        return False, f"columns differ: {sorted(s.columns)} vs {sorted(d.columns)}"
    if len(s) != len(d):
        return False, f"row count {len(s)} vs {len(d)}"
    rs, rd = rows(s), rows(d)
    bad = [(a, b) for a, b in zip(rs, rd) if a != b]
    if bad:
        return False, f"{len(bad)} rows differ, e.g. {bad[:2]}"
    return True, f"{len(s)} rows equal"
