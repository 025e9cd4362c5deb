"""Every registered query against its DuckDB oracle on the smallest tables."""
import math
import os

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from sensorlake.plans.queries import REGISTRY

TABLES = ["events"]


def _norm(v):
    if v is None:
        return "∅"
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v, 6))
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return str(v)


def _canon(records, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in records)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


@pytest.mark.parametrize("key", sorted(REGISTRY))
def test_query_matches_oracle(spark, con, key):
    df = E.queries()[key](spark, SF_SMALL)
    recs = [tuple(r) for r in df.collect()]
    sql = E.oracle_sql().get(key)
    if sql is None:
        assert df.columns
        return
    res = con.execute(sql)
    ocols = [d[0] for d in res.description]
    orecs = res.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(recs) == len(orecs)
    assert _canon(recs, df.columns) == _canon(orecs, ocols)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "rolling_avg_temperature" in df.columns


def test_runs_from_another_directory(tmp_path):
    """Python workers must not need the repository on their path (the
    driver may import the entry module from anywhere)."""
    import subprocess
    import sys
    script = tmp_path / "drive.py"
    script.write_text(f"""
import importlib.util
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
spec = importlib.util.spec_from_file_location("entry_mod", {os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "__spark_entry__.py")!r})
E = importlib.util.module_from_spec(spec); spec.loader.exec_module(E)
print("ROWS", E.queries()["stream_features"](spark, {SF_SMALL!r}).count(),
      E.queries()["src_table"](spark, {SF_SMALL!r}).count())
""")
    out = subprocess.run([sys.executable, str(script)], cwd=tmp_path, capture_output=True, text=True, timeout=600)
    line = [ln for ln in out.stdout.splitlines() if ln.startswith("ROWS")]
    assert line, out.stderr[-2000:]
    assert line[0] == "ROWS 776 1000"     # same counts as the in-process oracle checks
