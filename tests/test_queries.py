"""Every registered query against its SQL on the smallest tables, and the shape of plans."""

from __future__ import annotations

import json
import re
import subprocess
import sys
from pathlib import Path

import pytest

from __spark_entry__ import entry
from caseload.workload import REGISTERED
from compare import connect, differences

SF_DIR = "/root/testdata/sf0.001"


def queries():
    return {name: query for name, (query, _) in REGISTERED.items()}


def oracle_sql():
    return {name: sql for name, (_, sql) in REGISTERED.items() if sql}


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(queries()))
def test_query_equals_its_sql(spark, con, name):
    assert differences(con, spark, SF_DIR, queries()[name], oracle_sql()[name]) == []


def test_entry(spark):
    assert entry(spark).count() > 0


def test_every_query_has_sql():
    assert set(queries()) == set(oracle_sql())


def final_plan(df):
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.split("+- == Initial Plan")[0]


@pytest.mark.parametrize(
    "name, scans",
    [
        ("series_trend", 1),
        ("two_level_share", 3),
        ("market_share", 2),
        ("mart_enrollment_trends", 1),
        ("mart_mco_enrollment", 2),
        ("timeliness", 1),
        ("fractional_profile", 1),
    ],
)
def test_shares_and_series_read_each_table_once(spark, name, scans):
    plan = final_plan(queries()[name](spark, SF_DIR))
    assert len(re.findall("FileScan", plan)) == scans


@pytest.mark.parametrize("name", sorted(queries()))
def test_no_query_pairs_rows_without_a_key_or_leaves_the_jvm(spark, name):
    plan = queries()[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "MapInPandas"):
        assert operator not in plan


def test_only_needed_columns_are_read(spark):
    plan = final_plan(queries()["series_trend"](spark, SF_DIR))
    assert re.findall(r"ReadSchema: struct<([^>]*)>", plan) == [
        "o_totalprice:double,o_orderdate:timestamp_ntz,o_orderpriority:string"
    ]


def test_filters_reach_the_scan(spark):
    from pyspark.sql import functions as F

    from caseload.operators.rows import drop_value

    lines = spark.read.parquet(f"{SF_DIR}/lineitem.parquet")
    plan = final_plan(drop_value(lines, "l_returnflag", "A").select("l_orderkey"))
    assert re.search(r"PushedFilters: \[[^\]]*l_returnflag", plan)
    plan = final_plan(lines.where(F.col("l_shipdate") >= "1998-01-01").select("l_orderkey"))
    assert re.search(r"PushedFilters: \[[^\]]*l_shipdate", plan)


#: Reads of each table that a query may need: the rows of all its tables, so often.
READS = {
    "series_trend": {"orders": 1},
    "market_share": {"lineitem": 1, "part": 1},
    "shares_sum": {"lineitem": 1, "part": 1},
    "raw_enrollment_by_risk_group": {"orders": 1},
    "raw_chip_enrollment_detail": {"orders": 1},
    "raw_htw_enrollment": {"lineitem": 1},
    "raw_enrollment_by_county": {"orders": 1, "customer": 1, "nation": 1},
    "raw_timeliness_medicaid": {"lineitem": 1},
    "raw_mco_enrollment_by_sda": {"lineitem": 1, "part": 1, "supplier": 5},
    "block_decode": {"lineitem": 1, "part": 1, "supplier": 5},
    "dq_report": {"orders": 2, "lineitem": 1, "customer": 1, "nation": 1},
    "event_changes": {"events": 3},
}


def test_input_records(con):
    """As counted in the event log; sheets add their few fixed rows."""
    command = [sys.executable, str(Path(__file__).with_name("records.py")), SF_DIR, *READS]
    done = subprocess.run(command, capture_output=True, text=True, timeout=600, check=True)
    read = json.loads(done.stdout.strip().splitlines()[-1])
    for name, tables in READS.items():
        sizes = {t: con.execute(f"SELECT count(*) FROM {t}").fetchall()[0][0] for t in tables}
        assert 0 < read[name] <= sum(n * sizes[t] for t, n in tables.items()) + 2, name
