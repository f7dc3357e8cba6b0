"""Runs queries and their SQL side by side and compares rows, columns and values.

    python tests/oracle.py [--sf DIR] [name ...]
"""

from __future__ import annotations

import argparse
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()
KINDS = {"BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string",
         "BOOLEAN": "boolean", "TIMESTAMP": "timestamp_ntz"}


def connect(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    return con


def _cell(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v + 0.0)
    return repr(v)


def _rows(rows, order):
    return sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def compare(df, con, sql: str) -> list[str]:
    """Differences between a DataFrame and the SQL result; empty when equal."""
    rel = con.sql(sql)
    mine = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    theirs = {c: KINDS.get(str(t), str(t)) for c, t in zip(rel.columns, rel.types)}
    names = sorted(mine)
    if names != sorted(theirs):
        return [f"columns differ: {names} / {sorted(theirs)}"]
    out = [f"type of {n}: {mine[n]} / {theirs[n]}" for n in names if mine[n] != theirs[n]]
    a = _rows(df.collect(), [df.columns.index(n) for n in names])
    b = _rows(rel.fetchall(), [rel.columns.index(n) for n in names])
    if len(a) != len(b):
        out.append(f"rows: {len(a)} / {len(b)}")
    if a != b:
        sa, sb = set(a), set(b)
        out.append(f"values differ ({names}): {list(sa - sb)[:3]} / {list(sb - sa)[:3]}")
    return out


def main() -> int:
    from __spark_entry__ import oracle_sql, queries
    from tidemark.session import get_spark
    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="/root/testdata/sf0.01")
    parser.add_argument("names", nargs="*")
    args = parser.parse_args()
    spark = get_spark(master="local[8]", spark__sql__shuffle__partitions="8", spark__driver__memory="8g")
    spark.sparkContext.setLogLevel("ERROR")
    con, sqls, bad = connect(args.sf), oracle_sql(), 0
    for name, fn in queries().items():
        if args.names and name not in args.names:
            continue
        start = time.time()
        try:
            df = fn(spark, args.sf)
            problems = compare(df, con, sqls[name]) if name in sqls else ([] if df.collect() else ["no rows"])
        except Exception as e:  # report and go on with the next query
            problems = [f"{type(e).__name__}: {str(e)[:600]}"]
        bad += bool(problems)
        print(f"{'FAIL' if problems else 'ok  '} {name} {time.time() - start:.1f}s{'' if name in sqls else ' (rows only)'}",
              *problems, sep="\n     " if problems else " ", flush=True)
    print(f"{bad} failed")
    return int(bool(bad))


if __name__ == "__main__":
    sys.exit(main())
