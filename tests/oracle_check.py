"""Compare every validation query with its SQL; also usable as ``python tests/oracle_check.py <sf> [query ...]``."""

from __future__ import annotations

import datetime as dt
import decimal
import math
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def _canonical(value):
    if isinstance(value, bool):
        return value
    if isinstance(value, (int, float, decimal.Decimal)):
        number = float(value)
        return "NaN" if math.isnan(number) else f"{number:.9g}"
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    return str(value) if isinstance(value, dt.date) else value


def rows_of(columns, rows) -> tuple[list[str], Counter]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    names = [columns[i] for i in order]
    return names, Counter(tuple(_canonical(row[i]) for i in order) for row in rows)


def duck(folder: str):
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{folder}/{table}.parquet')")
    return connection


def expected(connection, sql: str) -> tuple[list[str], Counter]:
    result = connection.execute(sql)
    return rows_of([d[0] for d in result.description], result.fetchall())


def actual(df) -> tuple[list[str], Counter]:
    return rows_of(df.columns, df.collect())


if __name__ == "__main__":
    import __spark_entry__ as entry
    from tests.conftest import make_session

    spark = make_session()
    sf, names = sys.argv[1], sys.argv[2:]
    folder = f"/root/testdata/sf{sf}"
    connection = duck(folder)
    bad = 0
    for name, run in entry.queries().items():
        if names and name not in names or name not in entry.oracle_sql():
            continue
        begun = time.time()
        try:
            have = actual(run(spark, folder))
            want = expected(connection, entry.oracle_sql()[name])
        except Exception as error:  # report and go on with the next query
            print(f"{name:32s} ERROR {str(error)[:600]}")
            bad += 1
            continue
        same = have == want
        bad += not same
        print(f"{name:32s} {'ok  ' if same else 'DIFF'} {sum(have[1].values()):8d} rows {time.time() - begun:6.2f}s")
        if not same:
            print("  columns", have[0], want[0])
            print("  only spark", list((have[1] - want[1]).items())[:3], "\n  only sql", list((want[1] - have[1]).items())[:3])
    missing = sorted(set(entry.queries()) ^ set(entry.oracle_sql()))
    print("queries", len(entry.queries()), "bad", bad, "without SQL", missing)
    spark.stop()
