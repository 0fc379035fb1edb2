"""Compare registered queries with their SQL on DuckDB.

    python tests/compare.py [sf_dir] [query ...]
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")
KINDS = {
    "bigint": "BIGINT", "int": "INTEGER", "smallint": "SMALLINT", "double": "DOUBLE",
    "float": "FLOAT", "string": "VARCHAR", "date": "DATE", "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP", "timestamp": "TIMESTAMP WITH TIME ZONE",
}


def connect(sf: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return con


def _key(row):
    return tuple((v is not None, str(type(v)), v if v is not None else 0) for v in row)


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else v + 0.0
    return v


def compare(df, con, sql: str) -> tuple[int, list[str]]:
    """Row count and a list of differences (empty when equal)."""
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    kinds = {d[0]: str(d[1]) for d in cur.description}
    want = cur.fetchall()
    problems = []
    if sorted(names) != sorted(df.columns):
        return len(want), [f"columns {sorted(df.columns)} != {sorted(names)}"]
    for f in df.schema.fields:
        kind = KINDS.get(f.dataType.simpleString(), f.dataType.simpleString())
        if kind != kinds[f.name]:
            problems.append(f"type of {f.name}: {kind} != {kinds[f.name]}")
    order = sorted(names)
    at = [names.index(c) for c in order]
    a = sorted((tuple(_norm(row[c]) for c in order) for row in df.collect()), key=_key)
    b = sorted((tuple(_norm(row[i]) for i in at) for row in want), key=_key)
    if len(a) != len(b):
        problems.append(f"{len(a)} rows != {len(b)}")
    bad = [(x, y) for x, y in zip(a, b, strict=False) if x != y]
    if bad:
        problems.append(f"{len(bad)} rows differ, first: {order} {bad[0]}")
    return len(a), problems


def main() -> int:
    from __spark_entry__ import oracle_sql, queries
    from croptide.session import build_session

    args = sys.argv[1:]
    sf = args.pop(0) if args and "/" in args[0] else "/root/testdata/sf0.01"
    spark = build_session("compare", 8)
    spark.sparkContext.setLogLevel("ERROR")
    con, sqls, failed = connect(sf), oracle_sql(), 0
    for name, fn in queries().items():
        if args and name not in args:
            continue
        t = time.time()
        try:
            n, problems = (compare(fn(spark, sf), con, sqls[name]) if name in sqls
                           else (fn(spark, sf).count(), []))
        except Exception as e:
            n, problems = -1, [f"{type(e).__name__}: {str(e)[:1500]}"]
        failed += bool(problems)
        print(f"{'FAIL' if problems else 'ok  '} {name:28s} {n:8d} rows "
              f"{time.time() - t:6.2f}s", *problems, flush=True)
    print("failed:", failed)
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
