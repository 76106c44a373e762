"""Driver contract: entry smoke, query / oracle registry consistency, Spark-free oracle import."""

import os
import subprocess
import sys

import __spark_entry__ as E

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) == 1
    assert df.columns == ["total_rows", "min_key", "max_key", "expected", "missing", "latest_ts", "gap_regions",
                          "largest_gap", "missing_in_gaps"]
    r = rows[0]
    assert r.missing == r.missing_in_gaps


def test_oracle_keys_subset_of_queries():
    q, s = E.queries(), E.oracle_sql()
    assert set(s) <= set(q) and len(q) >= 80


def test_oracle_sql_needs_no_spark():
    code = "import __spark_entry__ as E; print(len(E.oracle_sql()))"
    out = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, timeout=120)
    assert out.returncode == 0, out.stderr[-2000:]
    assert int(out.stdout.strip()) >= 80
