"""Runs queries and SQL twins side by side: ``python -m checks.compare [sf_dir] [name ...]``."""

from __future__ import annotations

import math
import sys
import time
import traceback
from pathlib import Path

import duckdb

import checks.families  # noqa: F401
from checks.base import ORACLES, QUERIES
from tidewire.session import build_session


def database(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for file in sorted(Path(sf).glob("*.parquet")):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return con


def _cell(value: object) -> str:
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(float(f"{value:.9g}") + 0.0)
    return repr(value)


def normalised(columns: list[str], rows: list[tuple]) -> list[tuple[str, ...]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def difference(spark, con, sf: str, name: str) -> str | None:
    """None when both sides agree in columns, values and value types, else what differs."""
    got = QUERIES[name](spark, sf)
    rows = [tuple(r) for r in got.collect()]
    twin = con.execute(ORACLES[name])
    columns = [d[0] for d in twin.description]
    want = twin.fetchall()
    if sorted(columns) != sorted(got.columns):
        return f"columns {sorted(got.columns)} against {sorted(columns)}"
    a, b = normalised(got.columns, rows), normalised(columns, want)
    if a == b:
        return None
    pairs = [(x, y) for x, y in zip(a, b, strict=False) if x != y][:2]
    return f"rows {len(a)} against {len(b)}; first differences {str(pairs)[:1500]}"


def main(argv: list[str]) -> int:
    sf = argv[0] if argv else "/root/testdata/sf0.01"
    names = argv[1:] or list(QUERIES)
    spark = build_session(
        master="local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "8g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = database(sf), 0
    for name in names:
        start = time.time()
        try:
            if name in ORACLES:
                found = difference(spark, con, sf, name)
            else:
                found = None if QUERIES[name](spark, sf).count() >= 0 else "negative"
        except Exception:  # noqa: BLE001 - report and go on
            found = traceback.format_exc()[-1500:]
        bad += found is not None
        print(f"{'ok ' if found is None else 'BAD'} {name} {time.time() - start:.2f}s {found or ''}", flush=True)
    print(f"{len(names) - bad} of {len(names)} agree")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
