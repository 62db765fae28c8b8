"""Spark result vs DuckDB oracle: same column names, same row count, same rows (order-insensitive).

Doubles are compared exactly first; a relative tolerance of 1e-9 is reported separately so that a
last-bit difference is visible but not fatal.
"""

from __future__ import annotations

import math

import duckdb
import pandas as pd

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None or v is pd.NA or v is pd.NaT:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return float(v)
    if hasattr(v, "item") and not isinstance(v, (list, tuple, dict)):
        try:
            return _norm(v.item())
        except (ValueError, AttributeError):
            pass
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if hasattr(v, "tolist"):
        return tuple(_norm(x) for x in v.tolist())
    return v


def _rows(df: pd.DataFrame) -> list[tuple]:
    cols = sorted(df.columns)
    out = [tuple(_norm(x) for x in r) for r in df[cols].itertuples(index=False, name=None)]
    return sorted(out, key=lambda r: tuple((x is None, str(type(x)), x if not isinstance(x, tuple) else str(x)) for x in r))


def _close(a, b, rel=1e-9):
    if isinstance(a, float) and isinstance(b, (float, int)) or isinstance(b, float) and isinstance(a, (float, int)):
        return math.isclose(float(a), float(b), rel_tol=rel, abs_tol=1e-12)
    if isinstance(a, tuple) and isinstance(b, tuple):
        return len(a) == len(b) and all(_close(x, y, rel) for x, y in zip(a, b))
    return a == b


def compare(spark_pdf: pd.DataFrame, duck_pdf: pd.DataFrame) -> dict:
    res = {"spark_rows": len(spark_pdf), "oracle_rows": len(duck_pdf),
           "spark_cols": sorted(spark_pdf.columns), "oracle_cols": sorted(duck_pdf.columns)}
    res["cols_match"] = res["spark_cols"] == res["oracle_cols"]
    res["rows_match"] = res["spark_rows"] == res["oracle_rows"]
    if not (res["cols_match"] and res["rows_match"]):
        res["exact"] = res["close"] = False
        return res
    a, b = _rows(spark_pdf), _rows(duck_pdf)
    res["exact"] = a == b
    bad = [(x, y) for x, y in zip(a, b) if not _close(x, y)]
    res["close"] = not bad
    res["first_diff"] = [str(bad[0][0])[:300], str(bad[0][1])[:300]] if bad else None
    return res


def spark_pdf(df) -> pd.DataFrame:
    rows = df.collect()
    return pd.DataFrame([r.asDict() for r in rows], columns=df.columns)
