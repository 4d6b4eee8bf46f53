"""Compare registered queries with their SQL on the same Parquet files, in an in-process DuckDB."""

from __future__ import annotations

import decimal
import math
import sys
import time
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def cell(value):
    if value is None or value != value:
        return None
    if isinstance(value, decimal.Decimal):
        return str(value)
    if isinstance(value, float):
        return 0.0 if value == 0 else float(f"{value:.9g}") if math.isfinite(value) else str(value)
    return value


def canonical(columns: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(cell(r[i]) for i in order) for r in rows), key=repr)


def oracle_rows(sf_dir: str, sql: str) -> tuple[list[str], list[tuple]]:
    with duckdb.connect() as db:
        for name in TABLES:
            db.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
        result = db.execute(sql)
        return [d[0] for d in result.description], result.fetchall()


def difference(spark, sf_dir: str, query, sql: str) -> str | None:
    """None where both sides hold the same rows, else what differs."""
    frame = query(spark, sf_dir)
    ours = canonical(frame.columns, [tuple(r) for r in frame.collect()])
    columns, rows = oracle_rows(sf_dir, sql)
    theirs = canonical(columns, rows)
    if sorted(frame.columns) != sorted(columns):
        return f"columns {sorted(frame.columns)} != {sorted(columns)}"
    if len(ours) != len(theirs):
        extra = [r for r in ours if r not in set(theirs)][:3]
        lack = [r for r in theirs if r not in set(ours)][:3]
        return f"{len(ours)} rows != {len(theirs)}; only ours {extra}; only theirs {lack}"
    apart = [(a, b) for a, b in zip(ours, theirs) if a != b]
    return f"{len(apart)} rows differ, e.g. {apart[:2]}" if apart else None


if __name__ == "__main__":
    sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
    from __spark_entry__ import oracle_sql, queries
    from tests.conftest import new_session

    session = new_session()
    folder, wanted = sys.argv[1], sys.argv[2:]
    texts = oracle_sql()
    for key, run in queries().items():
        if wanted and key not in wanted:
            continue
        begun = time.time()
        try:
            found = difference(session, folder, run, texts[key]) or "ok"
        except Exception as error:  # show every query's fate
            found = f"ERROR {type(error).__name__}: {str(error)[:1500]}"
        print(f"{key:32s} {time.time() - begun:6.2f}s {found[:1800]}", flush=True)
