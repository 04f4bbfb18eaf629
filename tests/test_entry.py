import os

import pytest

import __spark_entry__ as entry
from tests.check_oracles import compare

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="test tables are not here")


@pytest.fixture(scope="module")
def con():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for f in os.listdir(DATA):
        con.execute(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{DATA}/{f}'")
    return con


def test_names_match():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_flagship(spark):
    assert entry.entry(spark).count() == 5000


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query_equals_its_sql(spark, con, name):
    text, _, ok = compare(spark, con, name, entry.queries()[name], entry.oracle_sql().get(name), DATA)
    assert ok, text


def test_tasks_need_no_installed_package(tmp_path):
    """Task functions travel by value: a session started elsewhere, without this folder on the workers' path, works."""
    import subprocess
    import sys

    script = f"""
import importlib.util
spec = importlib.util.spec_from_file_location("entry", {entry.__file__!r})
entry = importlib.util.module_from_spec(spec)
spec.loader.exec_module(entry)
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2").getOrCreate()
for name in ("r04_late_interaction", "r01_mmr", "s11_ivf_search_cosine", "s12_pq_scan", "s13_two_phase", "q12_ivf_train"):
    assert entry.queries()[name](spark, {DATA!r}).count() > 0
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", script], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr[-2000:]
