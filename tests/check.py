"""Compare registered queries with their SQL: ``python tests/check.py [sf] [name ...]``."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 9)
    if hasattr(value, "as_integer_ratio") and not isinstance(value, int):
        return float(value)
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(plain(r[i]) for i in order) for r in rows]
    return sorted(out, key=repr), [columns[i] for i in order]


def compare(name, df, con, sql):
    """Differences between a Spark result and its SQL, empty when equal."""
    got, got_columns = rows_of(df.columns, df.collect())
    cursor = con.execute(sql)
    columns = [d[0] for d in cursor.description]
    want, want_columns = rows_of(columns, cursor.fetchall())
    if got_columns != want_columns:
        return [f"{name}: columns {got_columns} != {want_columns}"]
    if got == want:
        return []
    only_got = [r for r in got if r not in set(want)][:3]
    only_want = [r for r in want if r not in set(got)][:3]
    return [f"{name}: {len(got)} rows vs {len(want)}\n  spark {only_got}\n  sql   {only_want}"]


def main():
    from __spark_entry__ import oracle_sql, queries
    from wardflow.session import local_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    sf_dir = f"/root/testdata/sf{sf}"
    names = sys.argv[2:] or list(queries())
    spark, con = local_session(), connect(sf_dir)
    failed = 0
    for name in names:
        start = time.time()
        try:
            df = queries()[name](spark, sf_dir)
            sql = oracle_sql().get(name)
            if sql is None:
                print(f"rows {name}: {df.count()} {time.time() - start:.1f}s", flush=True)
                continue
            found = compare(name, df, con, sql)
        except Exception as error:  # noqa: BLE001 - report and go on
            found = [f"{name}: {type(error).__name__} {str(error)[:1500]}"]
        failed += bool(found)
        print("ok  " if not found else "FAIL", name, f"{time.time() - start:.1f}s", flush=True)
        for line in found:
            print(line[:2500], flush=True)
    print(f"{len(names) - failed} of {len(names)} equal")


if __name__ == "__main__":
    main()
