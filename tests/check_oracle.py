"""Compare registered queries with their SQL on the driver tables: python tests/check_oracle.py [sf] [name ...]."""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
import pandas as pd

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def duck(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf}/{name}.parquet')")
    return con


def _canonical(frame: pd.DataFrame) -> list[tuple]:
    """Rows as sorted tuples with columns in name order; a float stays at full precision."""
    frame = frame[sorted(frame.columns)]

    def cell(v):
        if v is None or (isinstance(v, float) and v != v) or v is pd.NaT or v is pd.NA:
            return "NULL"
        if isinstance(v, float):
            return repr(float(v) + 0.0)
        if hasattr(v, "isoformat"):
            return str(v)[:10] if str(v)[10:] in ("", " 00:00:00") else str(v)
        if hasattr(v, "item"):
            return repr(v.item())
        return repr(v)

    return sorted(tuple(cell(v) for v in row) for row in frame.astype(object).itertuples(index=False))


def differences(spark_rows: pd.DataFrame, sql_rows: pd.DataFrame) -> str | None:
    if sorted(spark_rows.columns) != sorted(sql_rows.columns):
        return f"columns differ: {sorted(set(spark_rows.columns) ^ set(sql_rows.columns))}"
    a, b = _canonical(spark_rows), _canonical(sql_rows)
    if len(a) != len(b):
        return f"rows differ: {len(a)} and {len(b)}"
    wrong = [(x, y) for x, y in zip(a, b) if x != y]
    return f"{len(wrong)} of {len(a)} rows differ, first {wrong[0]}" if wrong else None


def type_notes(df, sql_rows) -> str:
    spark_types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    duck_types = dict(zip(sql_rows.columns, map(str, sql_rows.types)))
    same = {
        "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE",
        "boolean": "BOOLEAN", "tinyint": "TINYINT", "timestamp_ntz": "TIMESTAMP", "float": "FLOAT",
    }
    off = {c: (t, duck_types.get(c)) for c, t in spark_types.items() if same.get(t, t) != duck_types.get(c)}
    return f" types {off}" if off else ""


def main(sf: str, names: list[str]) -> int:
    from tests.conftest import make_session

    import __spark_entry__ as entry

    spark = make_session()
    con = duck(sf)
    oracles, bad = entry.oracle_sql(), 0
    for name, function in entry.queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            df = function(spark, sf)
            rows = df.toPandas()
            took = time.time() - start
            if name not in oracles:
                print(f"{name:32s} rows-only {len(rows):7d} {took:6.2f}s")
                bad += len(rows) == 0
                continue
            relation = con.sql(oracles[name])
            notes = type_notes(df, relation)
            problem = differences(rows, relation.df())
        except Exception as error:  # noqa: BLE001
            problem, notes, rows, took = f"{type(error).__name__}: {str(error)[:600]}", "", [], time.time() - start
        bad += problem is not None or bool(notes)
        print(f"{name:32s} {'ok' if problem is None else 'FAIL ' + problem} {len(rows):7d} {took:6.2f}s{notes}", flush=True)
    print("failures:", bad)
    return bad


if __name__ == "__main__":
    scale = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    sys.exit(1 if main(f"/root/testdata/sf{scale}", sys.argv[2:]) else 0)
