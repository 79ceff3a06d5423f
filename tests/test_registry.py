"""The registry is made anywhere: no session, no file outside the repository."""

from __future__ import annotations

import subprocess
import sys
from pathlib import Path

ALONE = """
import sys

def watch(event, args):
    if event == "open" and str(args[0]).endswith(".jar"):
        raise RuntimeError(f"opens {args[0]}")

sys.addaudithook(watch)
import __spark_entry__ as entry

queries, sql = entry.queries(), entry.oracle_sql()
assert set(sql) <= set(queries), set(sql) - set(queries)
from pyspark.sql import SparkSession
assert SparkSession.getActiveSession() is None
print(len(queries))
"""


def test_queries_and_sql_without_a_session_or_jars():
    done = subprocess.run(
        [sys.executable, "-c", ALONE], cwd=Path(__file__).resolve().parents[1], capture_output=True, text=True, timeout=120
    )
    assert done.returncode == 0, done.stderr
    assert int(done.stdout) > 100
