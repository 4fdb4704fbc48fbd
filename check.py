"""Compare registered queries with their SQL: python check.py [sf_dir] [name ...]"""

from __future__ import annotations

import sys
import time

import duckdb

from bench import make_session
from tallyworks.plans import oracle_sql, queries

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def normal(value):
    if isinstance(value, float):
        return "nan" if value != value else repr(value)
    return str(value)


def as_rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(normal(row[i]) for i in order) for row in data)


def main() -> int:
    path = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:]
    spark = make_session("check")
    db = duckdb.connect()
    for t in TABLES:
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{path}/{t}.parquet'")
    sql, failed = oracle_sql(), []
    for name, run in queries().items():
        if names and name not in names:
            continue
        started = time.time()
        try:
            df = run(spark, path)
            got = as_rows(df.columns, df.collect())
        except Exception as error:  # noqa: BLE001
            failed.append(name)
            print(f"ERROR {name}: {str(error)[:1500]}", flush=True)
            continue
        took = time.time() - started
        if name not in sql:
            print(f"rows  {name}: {len(got)} rows {took:.1f}s", flush=True)
            continue
        started = time.time()
        try:
            cursor = db.execute(sql[name])
            want = as_rows([d[0] for d in cursor.description], cursor.fetchall())
        except Exception as error:  # noqa: BLE001
            failed.append(name)
            print(f"SQL ERROR {name}: {str(error)[:1500]}", flush=True)
            continue
        sql_took = time.time() - started
        if got == want:
            print(f"ok    {name}: {len(got)} rows {took:.1f}s (sql {sql_took:.2f}s)", flush=True)
        else:
            failed.append(name)
            extra = [r for r in got if r not in set(want)][:3]
            missing = [r for r in want if r not in set(got)][:3]
            print(f"DIFF  {name}: {len(got)} vs {len(want)}\n  spark {extra}\n  sql   {missing}", flush=True)
    print(f"{len(failed)} failed: {failed}")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
