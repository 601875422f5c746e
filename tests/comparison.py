"""Compare registered queries with their SQL in DuckDB (same rules as the outer check)."""

from __future__ import annotations

import datetime
import math
import sys
import time
from decimal import Decimal
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def norm(value):
    if isinstance(value, (bool, int)):
        return str(int(value))
    if isinstance(value, Decimal):
        value = float(value)
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return f"{value + 0.0:.6f}".replace("-0.000000", "0.000000")
    if isinstance(value, (list, tuple)):
        return "[" + ",".join(norm(v) for v in value) + "]"
    if isinstance(value, dict):
        return "{" + ",".join(f"{k}:{norm(v)}" for k, v in sorted(value.items())) + "}"
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    return str(value)


def connect(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for name in TABLES:
        path = Path(sf_dir) / f"{name}.parquet"
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(norm(r[i]) for i in order) for r in rows)


def compare(spark, con, sf_dir, name, query, sql):
    """(ok, message) for one query."""
    start = time.time()
    df = query(spark, sf_dir)
    got = [tuple(r) for r in df.collect()]
    spent = time.time() - start
    columns, rows = rows_of(df.columns, got)
    if sql is None:
        return True, f"{len(rows)} rows, no SQL, {spent:.1f}s"
    cur = con.execute(sql)
    want_columns, want = rows_of([d[0] for d in cur.description], cur.fetchall())
    if columns != want_columns:
        return False, f"columns {columns} != {want_columns}"
    if rows != want:
        only = list(set(rows) - set(want))[:3], list(set(want) - set(rows))[:3]
        return False, f"{len(rows)} vs {len(want)} rows; only here {only[0]}; only SQL {only[1]}"
    return True, f"{len(rows)} rows, {spent:.1f}s"


def main(argv: list[str]) -> int:
    from trackloom.plans.registry import oracle_sql, queries
    from trackloom.session import build_session

    sf_dir, wanted = argv[0], argv[1:]
    spark = build_session("check", "8")
    spark.sparkContext.setLogLevel("ERROR")
    con, sql, bad = connect(sf_dir), oracle_sql(), []
    for name, query in queries().items():
        if wanted and name not in wanted:
            continue
        try:
            ok, message = compare(spark, con, sf_dir, name, query, sql.get(name))
        except Exception as error:  # report and go on with the next query
            ok, message = False, f"{type(error).__name__}: {str(error)[:600]}"
        print("ok  " if ok else "FAIL", name, message, flush=True)
        if not ok:
            bad.append(name)
    print("failed:", bad)
    return len(bad)


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
