"""Compare registered queries with their SQL on the same tables (also a script)."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb
import pandas as pd

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


def oracle_connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES.split():
        if Path(f"{sf_dir}/{name}.parquet").exists():
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    if value is None or value is pd.NaT:
        return None
    if isinstance(value, float):
        return None if math.isnan(value) else (int(value) if value.is_integer() else round(value, 9))
    if hasattr(value, "item"):
        return _plain(value.item())
    return str(value) if isinstance(value, pd.Timestamp) else value


def rows_of(frame: pd.DataFrame) -> list[tuple]:
    columns = sorted(frame.columns)
    data = [tuple(_plain(v) for v in row) for row in frame[columns].astype(object).itertuples(index=False)]
    return sorted(data, key=lambda r: tuple((v is not None, str(type(v)), str(v)) for v in r))


def compare(spark_frame: pd.DataFrame, oracle_frame: pd.DataFrame) -> str | None:
    """None when equal, else what differs."""
    if sorted(spark_frame.columns) != sorted(oracle_frame.columns):
        return f"columns {sorted(spark_frame.columns)} != {sorted(oracle_frame.columns)}"
    if len(spark_frame) != len(oracle_frame):
        return f"rows {len(spark_frame)} != {len(oracle_frame)}"
    for a, b in zip(rows_of(spark_frame), rows_of(oracle_frame)):
        if a != b:
            return f"{sorted(spark_frame.columns)}\n  spark  {a}\n  oracle {b}"
    return None


def main() -> int:
    sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
    import __spark_entry__ as entry

    from logloom.session import local_session

    sf_dir = sys.argv[1]
    wanted = sys.argv[2:]
    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    con = oracle_connection(sf_dir)
    queries, oracles = entry.queries(), entry.oracle_sql()
    bad = 0
    for name, fn in queries.items():
        if wanted and not any(name == w or (w.endswith("*") and name.startswith(w[:-1])) for w in wanted):
            continue
        started = time.time()
        try:
            got = fn(spark, sf_dir).toPandas()
            took = time.time() - started
            problem = compare(got, con.execute(oracles[name]).df()) if name in oracles else None
            note = f"{len(got)} rows" + ("" if name in oracles else ", no oracle")
        except Exception as e:  # noqa: BLE001
            took, problem, note = time.time() - started, f"{type(e).__name__}: {str(e)[:1500]}", ""
        bad += problem is not None
        print(f"{'FAIL' if problem else 'ok  '} {name} {took:.1f}s {note} {problem or ''}", flush=True)
    print(f"{bad} failed")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
