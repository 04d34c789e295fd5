"""Every registered query against its SQL check on the smallest data set, and its plan."""

import os
import subprocess
import sys
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry_module
from gleanframe.plans import catalog

ROOT = Path(__file__).resolve().parents[1]
SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
QUERIES, CHECKS = catalog.QUERIES, catalog.CHECKS
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def check():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return connection


def normal(row):
    return tuple(round(v, 9) if isinstance(v, float) else v for v in row)


def sorted_rows(rows):
    return sorted(map(normal, rows), key=lambda row: tuple((v is None, str(v)) for v in row))


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, check, name):
    df = QUERIES[name](spark, SF_DIR)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BatchEvalPython" not in plan
    assert "BroadcastNestedLoopJoin" not in plan
    result = check.execute(CHECKS[name])
    columns = [column[0] for column in result.description]
    assert sorted(columns) == sorted(df.columns)
    got = [tuple(row[c] for c in columns) for row in df.collect()]
    assert sorted_rows(got) == sorted_rows(result.fetchall())


def test_every_query_has_a_check():
    assert set(QUERIES) == set(CHECKS)


def test_entry(spark):
    assert entry_module.entry(spark).count() > 0


@pytest.mark.parametrize("name", ["failure_ledger", "circuit_state", "retry_schedule"])
def test_zone_of_session_does_not_matter(spark, name):
    want = sorted_rows(QUERIES[name](spark, SF_DIR).collect())
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        got = sorted_rows(QUERIES[name](spark, SF_DIR).collect())
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert got == want



def test_scans_read_only_what_they_need(spark):
    plan = QUERIES["first_number"](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in plan
    plan = QUERIES["duplicate_report"](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert "o_totalprice" not in plan
    plan = QUERIES["error_class"](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert "value:double" not in plan


def test_workers_need_no_copy_of_the_package(tmp_path):
    """Entry and extraction work when started elsewhere, with workers that cannot import the package."""
    code = f"""
import sys; sys.path.insert(0, {str(ROOT)!r})
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
import __spark_entry__ as e
assert e.entry(spark).count() > 0
assert e.queries()["page_extract"](spark, {SF_DIR!r}).count() > 0
"""
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr[-2000:]
