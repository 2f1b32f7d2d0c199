"""Queries on a copy of the tables in which a third of the rows share a key or a moment."""

from __future__ import annotations

from pathlib import Path

import pytest

from caseload.workload import REGISTERED
from compare import connect, differences

SF_DIR = "/root/testdata/sf0.001"
#: Table, and the columns that a third of its rows share, as SQL values.
HOT = {
    "lineitem": {"l_partkey": "7", "l_suppkey": "3"},
    "orders": {"o_custkey": "5", "o_orderpriority": "'2-HIGH'"},
    "events": {"ts": "TIMESTAMP '2024-01-15 12:00:00'", "event_type": "'view'"},
}


@pytest.fixture(scope="module")
def skewed(tmp_path_factory):
    folder = tmp_path_factory.mktemp("skewed")
    con = connect(SF_DIR)
    for path in Path(SF_DIR).glob("*.parquet"):
        name = path.stem
        if name not in HOT:
            (folder / path.name).symlink_to(path)
            continue
        id_column = {"lineitem": "l_orderkey", "orders": "o_orderkey", "events": "event_id"}[name]
        changes = ", ".join(
            f"CASE WHEN {id_column} % 3 = 0 THEN {value} ELSE {c} END AS {c}" for c, value in HOT[name].items()
        )
        con.execute(f"COPY (SELECT * REPLACE ({changes}) FROM {name}) TO '{folder / path.name}' (FORMAT parquet)")
    return str(folder)


@pytest.mark.parametrize(
    "name",
    [
        "series_trend", "two_level_share", "market_share", "shares_sum", "event_changes", "timeliness",
        "mart_mco_enrollment", "mart_enrollment_by_county", "dq_report", "raw_mco_enrollment_by_sda",
    ],
)
def test_skewed_tables(spark, skewed, name):
    query, sql = REGISTERED[name]
    assert differences(connect(skewed), spark, skewed, query, sql) == []


@pytest.fixture(scope="module")
def one_brand(tmp_path_factory):
    """All parts, and so all of their types, are of one brand."""
    folder = tmp_path_factory.mktemp("one_brand")
    con = connect(SF_DIR)
    for path in Path(SF_DIR).glob("*.parquet"):
        if path.stem != "part":
            (folder / path.name).symlink_to(path)
    con.execute(
        f"COPY (SELECT * REPLACE ('Brand#1' AS p_brand) FROM part) TO '{folder / 'part.parquet'}' (FORMAT parquet)"
    )
    return str(folder)


@pytest.mark.parametrize("name", ["market_share", "mart_mco_enrollment", "shares_sum"])
def test_one_coarse_key_for_all_rows(spark, one_brand, name):
    query, sql = REGISTERED[name]
    assert differences(connect(one_brand), spark, one_brand, query, sql) == []


@pytest.mark.parametrize("name", ["market_share", "mart_mco_enrollment", "shares_sum"])
def test_totals_need_no_window(spark, name):
    plan = REGISTERED[name][0](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan
