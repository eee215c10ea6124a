"""Compare registered queries with their SQL twins in DuckDB."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder: str):
    import duckdb

    db = duckdb.connect()
    for name in TABLES:
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return db


def _cell(value):
    if isinstance(value, float) and math.isnan(value):
        return "NaN"
    if isinstance(value, float) and value == 0:
        return 0.0
    if hasattr(value, "as_integer_ratio") and not isinstance(value, (int, float)):
        return float(value)
    return value


def _sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    picked = [tuple(_cell(row[i]) for i in order) for row in rows]
    return [columns[i] for i in order], sorted(picked, key=repr)


def compare(spark, db, folder, query, sql):
    """None if both give the same rows, else a short account of the difference."""
    frame = query(spark, folder)
    got_columns, got = _sorted_rows(frame.columns, [tuple(r) for r in frame.collect()])
    cursor = db.execute(sql)
    names = [d[0] for d in cursor.description]
    want_columns, want = _sorted_rows(names, cursor.fetchall())
    if got_columns != want_columns:
        return f"columns {got_columns} != {want_columns}"
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}"
    for a, b in zip(got, want, strict=True):
        if a != b or [type(x) for x in a] != [type(x) for x in b]:
            return f"first difference:\n   spark {a}\n  oracle {b}"
    return None if got else "no rows"


if __name__ == "__main__":
    import __spark_entry__ as entry
    from conftest import session

    scale = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    chosen = sys.argv[2:]
    folder = f"/root/testdata/sf{scale}"
    spark, db = session(), connect(folder)
    queries, oracles = entry.queries(), entry.oracle_sql()
    bad = 0
    for name in chosen or queries:
        started = time.time()
        try:
            if name in oracles:
                problem = compare(spark, db, folder, queries[name], oracles[name])
            else:
                rows = queries[name](spark, folder).collect()
                problem = None if rows else "no rows"
        except Exception as error:  # reported, the other queries still run
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        bad += problem is not None
        kind = "sql " if name in oracles else "rows"
        print(f"{'ok ' if problem is None else 'BAD'} {kind} {time.time() - started:6.2f}s {name}"
              + (f"\n  {problem}" if problem else ""), flush=True)
    print(f"{bad} bad")
