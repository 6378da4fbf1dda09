"""Compare every query with its SQL counterpart: ``python tests/check_oracle.py [sf] [name ...]``."""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
import pandas as pd

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import __spark_entry__ as driver  # noqa: E402
from railctx.session import build_session  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    db.execute("SET TimeZone = 'UTC'")
    for table in TABLES:
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return db


def normal(frame: pd.DataFrame) -> pd.DataFrame:
    """Columns by name, one spelling per value, rows sorted."""
    out = pd.DataFrame(index=frame.index)
    for name in sorted(frame.columns):
        column = frame[name]
        if pd.api.types.is_datetime64_any_dtype(column):
            out[name] = column.astype("datetime64[us]").astype(str)
        elif pd.api.types.is_bool_dtype(column):
            out[name] = column.astype(str)
        elif pd.api.types.is_numeric_dtype(column):
            out[name] = column.astype("float64").round(9).astype(str)
        else:
            out[name] = column.map(lambda v: "nan" if v is None or v is pd.NaT or v != v else _text(v))
    return out.sort_values(list(out.columns)).reset_index(drop=True)


def _text(value) -> str:
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, (int, float)):
        return str(round(float(value), 9))
    if hasattr(value, "isoformat"):
        return str(pd.Timestamp(value))
    return str(value)


def compare(spark, db, name: str, sf_dir: str) -> str | None:
    """None when equal, else the first difference."""
    got_raw = driver.queries()[name](spark, sf_dir).toPandas()
    got = normal(got_raw)
    want = normal(db.execute(driver.oracle_sql()[name]).df())
    if list(got.columns) != list(want.columns):
        return f"columns {sorted(set(got.columns) ^ set(want.columns))}"
    if len(got) != len(want):
        return f"rows {len(got)} against {len(want)}"
    for column in got.columns:
        differs = got[column] != want[column]
        if differs.any():
            at = differs.idxmax()
            return f"{column}: {int(differs.sum())} differ, {got.loc[at].to_dict()} / {want.loc[at].to_dict()}"
    return None if len(got) else "empty"


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    sf_dir = f"/root/testdata/sf{sf}"
    names = sys.argv[2:] or list(driver.queries())
    spark = build_session(
        "check", "local[8]", spark__sql__shuffle__partitions="8", spark__ui__showConsoleProgress="false"
    )
    spark.sparkContext.setLogLevel("ERROR")
    db = connect(sf_dir)
    for name in names:
        start = time.time()
        try:
            verdict = compare(spark, db, name, sf_dir)
        except Exception as error:  # noqa: BLE001
            verdict = f"{type(error).__name__}: {str(error)[:600]}"
        print(f"{'ok  ' if verdict is None else 'FAIL'} {name} {time.time() - start:.1f}s {verdict or ''}", flush=True)


if __name__ == "__main__":
    main()
