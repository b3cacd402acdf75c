"""Runs catalog queries on Spark and their SQL on DuckDB and compares the results."""

from __future__ import annotations

import sys
import time
from collections import Counter
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

import datetime as dt  # noqa: E402
import decimal  # noqa: E402

import duckdb  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def normal(value):
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, float) and value == int(value) and abs(value) < 1e15:
        return int(value)
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None)
    return value


def rows_of(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(normal(r[i]) for i in order) for r in rows)


def compare(spark, con, name: str, entry, sf_dir: str) -> str | None:
    """None when equal, else a short account of the difference."""
    df = entry.run(spark, sf_dir)
    found = rows_of(df.columns, df.collect())
    if entry.sql is None:
        return None if found else "no rows"
    result = con.execute(entry.sql)
    columns = [c[0] for c in result.description]
    if sorted(columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)} vs {sorted(columns)}"
    wanted = rows_of(columns, result.fetchall())
    if found == wanted:
        return None
    only, missing = list((found - wanted).items())[:2], list((wanted - found).items())[:2]
    return (
        f"rows {sum(found.values())} vs {sum(wanted.values())}, "
        f"{sum((found - wanted).values())} differ\n  spark {only}\n  sql   {missing}"
    )


def main() -> None:
    from larder.catalog import entries
    from larder.session import local_session

    sf_dir = "/root/testdata/sf" + (sys.argv[1] if len(sys.argv) > 1 else "0.01")
    picks = sys.argv[2:]
    spark = local_session("compare")
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    bad = 0
    for name, entry in entries().items():
        if picks and not any(name.startswith(p) for p in picks):
            continue
        start = time.time()
        try:
            problem = compare(spark, con, name, entry, sf_dir)
        except Exception as e:  # noqa: BLE001
            problem = f"{type(e).__name__}: {str(e)[:900]}"
        bad += problem is not None
        kind = "" if entry.sql else " (rows only)"
        print(f"{'ok  ' if problem is None else 'FAIL'} {name}{kind} {time.time() - start:.1f}s {problem or ''}", flush=True)
    print("failures:", bad)


if __name__ == "__main__":
    main()
