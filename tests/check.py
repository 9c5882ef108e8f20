"""Run registered queries next to their DuckDB statements and compare every value.

python tests/check.py [sf] [name ...]
"""

from __future__ import annotations

import datetime
import decimal
import math
import sys
import time
import traceback
from pathlib import Path

import duckdb

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

import __spark_entry__ as entry  # noqa: E402

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def duck(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def plain(value):
    if value is None or isinstance(value, (str, bool)):
        return value
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else (0.0 if value == 0 else value)
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    return value


def rows(names, data):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in data), key=repr)


def compare(spark, con, name: str, sf_dir: str, seen=None) -> str | None:
    """None when equal, otherwise what differs; `seen` is called with the text of the executed plan."""
    got = entry.queries()[name](spark, sf_dir)
    actual = rows(got.columns, got.collect())
    if seen:
        seen(got._jdf.queryExecution().executedPlan().toString())
    sql = entry.oracle_sql().get(name)
    if sql is None:
        return None if actual else "no rows"
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    expected = rows(names, cur.fetchall())
    if sorted(got.columns) != sorted(names):
        return f"columns {sorted(got.columns)} != {sorted(names)}"
    if len(actual) != len(expected):
        return f"rows {len(actual)} != {len(expected)}"
    bad = [(a, e) for a, e in zip(actual, expected) if a != e or [type(x) for x in a] != [type(x) for x in e]]
    if bad:
        return f"{len(bad)} of {len(actual)} rows differ, first:\n  {sorted(names)}\n  spark {bad[0][0]}\n  duck  {bad[0][1]}"
    if not actual:
        return "no rows"
    return None


def main() -> None:
    from conftest import make_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "0.001"
    sf_dir = f"/root/testdata/sf{sf}"
    names = sys.argv[2:] or list(entry.queries())
    spark = make_session()
    con = duck(sf_dir)
    failed = []
    for name in names:
        start = time.time()
        try:
            problem = compare(spark, con, name, sf_dir)
        except Exception as error:
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
            if "-v" in sys.argv:
                traceback.print_exc()
        kind = "S" if name in entry.oracle_sql() else "R"
        print(f"{'ok  ' if problem is None else 'FAIL'} {kind} {name} {time.time() - start:.1f}s", flush=True)
        if problem:
            failed.append(name)
            print("   ", problem, flush=True)
    print(f"{len(names) - len(failed)}/{len(names)} ok", "failed: " + " ".join(failed) if failed else "")


if __name__ == "__main__":
    main()
