"""Run queries and their SQL side by side: ``python tests/oracle_check.py [folder] [name part ...]``."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 6) + 0.0
    if isinstance(value, (list, tuple)):
        return tuple(_plain(v) for v in value)
    return value


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    plain = [tuple(_plain(row[i]) for i in order) for row in rows]
    return [names[i] for i in order], sorted(plain, key=repr)


def compare(df, con, sql: str) -> str:
    """Empty when both sides agree, else what differs."""
    spark_names, spark_rows = _rows(df.columns, [tuple(r) for r in df.collect()])
    cursor = con.execute(sql)
    duck_names, duck_rows = _rows([d[0] for d in cursor.description], cursor.fetchall())
    if spark_names != duck_names:
        return f"columns {spark_names} vs {duck_names}"
    if len(spark_rows) != len(duck_rows):
        return f"rows {len(spark_rows)} vs {len(duck_rows)}"
    for left, right in zip(spark_rows, duck_rows):
        if left != right:
            return f"values {left} vs {right}"
    for left, right in zip(spark_rows[:1], duck_rows[:1]):
        kinds = [(type(a).__name__, type(b).__name__) for a, b in zip(left, right)]
        if any(a != b for a, b in kinds):
            return f"types {kinds}"
    return ""


if __name__ == "__main__":
    from weftgraph.catalog import all_oracles, all_queries
    from weftgraph.session import local_session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    spark = local_session(8)
    con = connect(folder)
    oracles = all_oracles()
    bad = 0
    for name, run in all_queries().items():
        if wanted and not any(w in name for w in wanted):
            continue
        began = time.time()
        try:
            df = run(spark, folder)
            if name in oracles:
                problem = compare(df, con, oracles[name])
                note = f"rows={df.count()}" if not problem else ""
            else:
                problem, note = "", f"rows only: {df.count()}"
        except Exception as error:  # noqa: BLE001 - report and go on
            problem, note = f"{type(error).__name__}: {str(error)[:600]}", ""
        bad += bool(problem)
        print(f"{'FAIL' if problem else 'ok  '} {name} {time.time() - began:.2f}s {problem or note}", flush=True)
    print(f"{bad} failed")
    spark.stop()
