"""Compare registered queries with their SQL twins on the test tables.

    python tests/oracle_check.py [sf_dir] [name-prefix ...]
"""

from __future__ import annotations

import datetime as dt
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def duck(sf: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf}/{name}.parquet')")
    return con


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    return repr(v)


def rows_of(table):
    order = sorted(table.column_names)
    columns = [table.column(c).to_pylist() for c in order]
    return sorted(tuple(_norm(v) for v in row) for row in zip(*columns)) if columns else []


def types_of(table):
    return {f.name: str(f.type).replace("large_", "").replace("[us, tz=UTC]", "[us]").replace("string_view", "string") for f in table.schema}


def compare(df, con, statement: str) -> str | None:
    mine = df.toArrow()
    theirs = con.execute(statement).to_arrow_table()
    if sorted(mine.column_names) != sorted(theirs.column_names):
        return f"columns {sorted(mine.column_names)} vs {sorted(theirs.column_names)}"
    if mine.num_rows != theirs.num_rows:
        return f"rows {mine.num_rows} vs {theirs.num_rows}"
    a, b = rows_of(mine), rows_of(theirs)
    if a != b:
        bad = [(x, y) for x, y in zip(a, b) if x != y]
        return f"{len(bad)} rows differ, first {sorted(mine.column_names)}: {bad[0]}"
    ta, tb = types_of(mine), types_of(theirs)
    diff = {c: (ta[c], tb[c]) for c in ta if ta[c] != tb[c]}
    return f"types {diff}" if diff else None


def main() -> int:
    from salesmart.catalog import load
    from salesmart.session import local_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    prefixes = tuple(sys.argv[2:])
    queries, oracle = load()
    spark, con = local_session(), duck(sf)
    spark.sparkContext.setLogLevel("ERROR")
    bad = 0
    for name, build in queries.items():
        if prefixes and not name.startswith(prefixes):
            continue
        start = time.time()
        try:
            if name in oracle:
                problem = compare(build(spark, sf), con, oracle[name])
            else:
                n = build(spark, sf).count()
                problem = None if n else "no rows"
        except Exception as error:
            problem = f"{type(error).__name__}: {str(error)[:700]}"
        bad += bool(problem)
        mark = "FAIL" if problem else ("ok" if name in oracle else "rows")
        print(f"{mark:5}{time.time() - start:7.2f}s  {name}  {problem or ''}", flush=True)
    print(f"{bad} failed")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
