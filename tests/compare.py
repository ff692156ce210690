"""Runs registered queries beside their oracle SQL and compares the rows.

    python tests/compare.py [sf_dir] [name ...]
"""

from __future__ import annotations

import math
import pathlib
import sys
import time

import duckdb

ROOT = pathlib.Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _cell(value: object) -> object:
    if isinstance(value, float):
        return "NaN" if math.isnan(value) else round(value, 6)
    if isinstance(value, (list, tuple)):
        return tuple(_cell(v) for v in value)
    return value


def _rows(names: list[str], rows: list) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    out = [tuple(_cell(row[i]) for i in order) for row in rows]
    return sorted(out, key=repr)


def compare(spark, con, name: str, sf_dir: str, queries: dict, oracles: dict) -> str:
    """Empty when equal, else a description of the first difference."""
    df = queries[name](spark, sf_dir)
    got = _rows(df.columns, [tuple(r) for r in df.collect()])
    plan = df._jdf.queryExecution().executedPlan().toString()
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python"):
        if node in plan:
            return f"plan contains {node}"
    if name not in oracles:
        return "" if got else "no rows"
    result = con.execute(oracles[name])
    names = [d[0] for d in result.description]
    want = _rows(names, result.fetchall())
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    kinds = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    for column, kind in zip(names, [str(d[1]) for d in result.description]):
        same = {
            "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
            "date": "DATE", "timestamp": "TIMESTAMP", "boolean": "BOOLEAN",
        }.get(kinds[column])
        if same and same != kind:
            return f"type of {column}: {kinds[column]} vs {kind}"
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)}"
    for left, right in zip(got, want):
        if left != right:
            return f"row {left}\n      != {right}"
    return "" if got else "no rows on either side"


def main() -> int:
    from conftest import build

    import __spark_entry__ as entry

    args = sys.argv[1:]
    sf_dir = args[0] if args else "/root/testdata/sf0.01"
    queries, oracles = entry.queries(), entry.oracle_sql()
    spark, con = build(), connect(sf_dir)
    bad = 0
    for name in args[1:] or queries:
        started = time.perf_counter()
        try:
            problem = compare(spark, con, name, sf_dir, queries, oracles)
        except Exception as exc:  # report and go on
            problem = f"{type(exc).__name__}: {str(exc)[:1500]}"
        bad += bool(problem)
        kind = "oracle" if name in oracles else "rows"
        print(f"{'FAIL' if problem else 'ok':4} {kind:6} {time.perf_counter() - started:6.2f}s {name} {problem}", flush=True)
    print(f"{bad} failed")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
