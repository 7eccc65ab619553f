"""Run a registered query on Spark and its SQL on DuckDB over the same files, and compare."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pandas as pd


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return con


def canonical(frame: pd.DataFrame) -> pd.DataFrame:
    frame = frame[sorted(frame.columns)]
    # Text carries every value exactly; a missing value is one word whatever its type.
    text = frame.astype(object).where(frame.notna(), None).map(
        lambda v: "<null>" if v is None else repr(float(v)) if isinstance(v, (int, float))
        and not isinstance(v, bool) else str(v)
    )
    return text.sort_values(list(text.columns)).reset_index(drop=True)


def difference(spark_frame: pd.DataFrame, sql_frame: pd.DataFrame) -> str | None:
    if sorted(spark_frame.columns) != sorted(sql_frame.columns):
        return f"columns {sorted(spark_frame.columns)} != {sorted(sql_frame.columns)}"
    if len(spark_frame) != len(sql_frame):
        return f"{len(spark_frame)} rows != {len(sql_frame)}"
    kinds = [
        (c, str(spark_frame[c].dtype), str(sql_frame[c].dtype))
        for c in spark_frame.columns
        if spark_frame[c].dtype.kind != sql_frame[c].dtype.kind
    ]
    a, b = canonical(spark_frame), canonical(sql_frame)
    unequal = (a != b).any(axis=1)
    if unequal.any():
        at = unequal.idxmax()
        return f"{unequal.sum()} rows differ, first:\n{a.loc[at].to_dict()}\n{b.loc[at].to_dict()}"
    return f"types differ: {kinds}" if kinds else None
