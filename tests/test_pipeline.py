from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F

from caseload.functions.scalars import epoch_micros_to_date
from caseload.operators.quality import run_checks, shares_sum_to_one
from caseload.plans.pipeline import build_models, check_models, load_raw
from caseload.plans.staging import RISK_GROUP_CATEGORIES
from caseload.session import shared_folder
from caseload.sources import grid as landing
from caseload.sources import sinks
from landing import MONTHS, PLANS, land_all, months, write


@pytest.fixture(scope="module")
def loaded(spark, tmp_path_factory):
    report = load_raw(spark, land_all(tmp_path_factory.mktemp("landing"))).collect()
    lines = {}
    for r in report:
        lines.setdefault((r.table, r.file, r.status), []).append(r)
    return lines


@pytest.fixture(scope="module")
def built(spark, loaded):
    return {r.table: r.n_rows for r in build_models(spark).collect()}


def test_load_report(loaded):
    rows = {table: rs[0].n_rows for (table, file, _), rs in loaded.items() if file is None}
    plan_cells = sum(1 if b == 4 else 4 for b in range(PLANS))
    assert rows == {
        "enrollment_by_risk_group": MONTHS,
        "chip_enrollment_detail": MONTHS,
        "htw_enrollment": MONTHS,
        "enrollment_by_county": 3 * 255,
        "timeliness_medicaid": 4 * 2 * 45,
        "mco_enrollment_by_sda": 7 * plan_cells,
    }


def test_every_row_under_a_header_is_reported(loaded):
    lines = {}
    for (_, file, _), rs in loaded.items():
        if file:
            lines.setdefault(file, {}).update({r.message: r.n_rows for r in rs})
    assert lines["monthly-enrollment-by-risk-group.jsonl"] == {
        "": MONTHS, "blank row": 1, "no date in the month cell": 1,
    }
    assert lines["chip-enrollment-detail.jsonl"] == {"": MONTHS, "no date in the month cell": 1}
    assert lines["htw.jsonl"] == {"": MONTHS, "no date in the month cell": 1}
    county = "medicaid-enrollment-by-county-final-"
    assert lines[f"{county}may-2024.jsonl"] == {"": 255, "no county code": 4, "blank row": 1}
    assert lines[f"{county}july-2024.jsonl"] == {"not 11 columns": 1}
    assert lines["timeliness-medicaid-jan-2025.jsonl"] == {
        "": 90, "directly under the header": 2, "total row": 2, "after the total row": 2,
    }
    assert lines["timeliness-notes.jsonl"] == {"no month in the name": 2}
    assert lines["mco-enrollment-by-sda-final-sfy25.jsonl"] == {
        "": 10 * PLANS, "after the last block": 2,
    }


def test_raw_risk_groups(spark, loaded):
    raw = spark.table("RAW.enrollment_by_risk_group").orderBy("month")
    first = raw.withColumn("day", epoch_micros_to_date("month")).first()
    assert first.day == date(2014, 9, 1)
    assert (first.medicaid_caseload, first.childrens_medicaid_risk_group) == (1000.0, 1006.0)
    assert (first.childrens_medicaid_chip_group, first.regular_chip) == (1009.0, 1010.0)
    assert "loaded_at" in raw.columns


def test_raw_timeliness_by_header_name(spark, loaded):
    raw = spark.table("RAW.timeliness_medicaid")
    assert raw.where("region = 'TOTAL'").count() == 0
    assert raw.where("region is null").count() == 8
    assert raw.where("region = 'all regions' or region like '*%'").count() == 0
    assert raw.where("is_geographic_region").select("region").distinct().count() == 4
    for row in raw.where("region = '01'").collect():
        assert row.disposed == 100.0 and row.percent == row.timely / row.disposed


def test_raw_plan_names(spark, loaded):
    raw = spark.table("RAW.mco_enrollment_by_sda")
    assert raw.select("mco_name").distinct().count() == PLANS
    assert raw.where("mco_name = 'Plan 4'").count() == 7
    assert raw.where("program = 'TOTAL' or sub_program = 'TOTAL'").count() == 0


def test_mart_sizes(built):
    assert built == {
        "mart_enrollment_trends": 10 * MONTHS,
        "mart_enrollment_by_county": 3 * 255 * 8,
        "mart_timeliness_performance": 4 * 2 * (6 + 35),
        "mart_chip_enrollment": MONTHS,
        "mart_htw_caseload": MONTHS,
        "mart_mco_enrollment": 7 * sum(1 if b == 4 else 4 for b in range(PLANS)),
    }


def test_trend_labels_and_shares(spark, built):
    trends = spark.table("MARTS.mart_enrollment_trends")
    daily = trends.where("count_methodology = 'average_daily_enrollment'")
    first = {r.risk_group: r.m for r in daily.groupBy("risk_group").agg(F.min("report_month").alias("m")).collect()}
    assert first.pop("medicaid_clients_under_21") == date(2025, 9, 1)
    assert "regular_chip" not in first and set(first.values()) == {date(2025, 8, 1)}
    parts = RISK_GROUP_CATEGORIES["caseload_by_risk_group"]
    sums = trends.where(F.col("risk_group").isin(parts)).groupBy("report_month").agg(F.sum("pct_of_total"))
    assert all(r[1] == pytest.approx(1) for r in sums.collect())
    assert trends.where("mom_change is null").count() == 10
    assert trends.where("report_month = '2014-10-01' and mom_change <> 10").count() == 0


def test_county_mart(spark, built):
    mart = spark.table("MARTS.mart_enrollment_by_county")
    row = mart.where("county_code = 255 and risk_group = 'parents' and report_month = '2024-05-01'").first()
    # The third of nine measures of the second month, in which county 255 starts at 256.
    assert (row.county_name, row.is_unknown_county) == ("Unknown", True)
    assert (row.enrollment_count, row.mom_change) == (259, 1)
    assert row.mom_change_pct == 1 / 258
    assert row.pct_of_county_total == 259 / sum(256 + j for j in range(1, 7))
    assert row.pct_of_state_total == 259 / sum(code + 1 + 3 for code in range(1, 256))


def test_timeliness_mart(spark, built):
    mart = spark.table("MARTS.mart_timeliness_performance").where("record_type = 'applications'")
    regions = {r.region for r in mart.select("region").distinct().collect()}
    assert regions == {"01", "02/09", "03", "04", "05", "VIC", *(f"R{i}" for i in range(35))}
    series = mart.where("region = '01'").orderBy("report_month").collect()
    ratios = [0.80, 0.81, 0.82, 0.83]
    assert [r.pct_timely for r in series] == ratios
    assert [r.pct_timely_variance for r in series] == [0.0] * 4
    assert series[0].mom_change_pct_timely is None
    assert series[3].rolling_3m_pct_timely == pytest.approx(sum(ratios[1:]) / 3)
    zero = mart.where("region = '05'").first()
    assert (zero.disposed, zero.pct_timely) == (0, 0.0)
    staged = spark.table("stg_timeliness_medicaid").where("region = '05'").first()
    assert staged.pct_timely is None


def test_chip_mart_reconciles(spark, built):
    mart = spark.table("MARTS.mart_chip_enrollment").orderBy("report_month").collect()
    assert mart[0].caseload_reconciliation_variance_pct is None
    assert {r.caseload_reconciliation_variance_pct for r in mart[1:]} == {0.0}
    assert sum(r.mom_change_caseload for r in mart[1:]) == mart[-1].chip_caseload - 1000


def test_htw_mart(spark, built):
    mart = spark.table("MARTS.mart_htw_caseload").orderBy("report_month").collect()
    switch = [r for r in mart if r.report_month == date(2025, 8, 1)][0]
    assert (switch.count_methodology, switch.mom_change_caseload) == ("average_daily_caseload", 1.5)
    assert len(months(MONTHS)) == len(mart)


def test_plan_shares(spark, built):
    mart = spark.table("MARTS.mart_mco_enrollment")
    checks = [
        shares_sum_to_one("mco_share_of_sda", "program", "sub_program", "sda"),
        shares_sum_to_one("mco_share_of_program", "program", "sub_program"),
    ]
    assert all(r.passed for r in run_checks(mart, "m", checks).collect())


def test_declared_checks(spark, built):
    report = check_models(spark).collect()
    assert len(report) == 96 + 4 + 15
    # Region 05 disposes of nothing, so its staged percentage is missing in each month and type.
    failed = [(r.dataset, r.check, r.column, r.n_failed) for r in report if not r.passed]
    assert failed == [("stg_timeliness_medicaid", "not_null_where", "pct_timely", 8)]
    assert {r.n_rows for r in report if r.dataset == "mart_enrollment_trends"} == {10 * MONTHS}


def test_unknown_month_fails_the_table_and_not_the_others(spark, tmp_path):
    landing_folders = land_all(tmp_path)
    write(tmp_path / "enrollment_by_county", "county-final-soon-2024.jsonl", {3: [1, "x", *[1] * 9]})
    kept = {k: landing_folders[k] for k in ("enrollment_by_county", "htw_enrollment")}
    with pytest.raises(RuntimeError, match="enrollment_by_county"):
        load_raw(spark, kept, namespace="raw_failing")
    report = load_raw(spark, kept, namespace="raw_failing", tolerate=True).collect()
    assert {(r.table, r.status) for r in report if r.file is None} == {
        ("enrollment_by_county", "failed"),
        ("htw_enrollment", "loaded"),
    }


def test_full_refresh_replaces_rows_and_schema(spark):
    first = spark.createDataFrame([(1, "x"), (2, "y")], "a INT, b STRING")
    second = spark.createDataFrame([(3.5,)], "c DOUBLE")
    assert sinks.publish_table(first, "t", namespace=" fresh ").n_rows == 2
    outcome = sinks.publish_table(second, "t", namespace="fresh", audit_column="loaded_at")
    assert (outcome.status, outcome.n_rows) == ("loaded", 1)
    assert spark.table("FRESH.t").columns == ["c", "loaded_at"]


def test_namespace():
    assert sinks.target_namespace(None, "base") == "base"
    assert sinks.target_namespace(" marts ", "base") == "MARTS"


def test_named_grid_roundtrip(spark):
    rows = [("a.xlsx", "a.xlsx", 1, ["x\ny", None, "z"]), ("b.xlsx", "b.xlsx", 0, ["1"])]
    grid = spark.createDataFrame(
        rows, "source_path STRING, source_file STRING, row_idx INT, cells ARRAY<STRING>"
    )
    folder = shared_folder(spark)
    landing.write_named_grid(grid, folder)
    assert sorted(tuple(r) for r in landing.read_named_grid(spark, folder).collect()) == sorted(rows)


def test_shared_folder_is_the_one_the_session_names(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    first, second = shared_folder(spark), shared_folder(spark)
    assert first.startswith(root) and second.startswith(root) and first != second


PINNED = {
    "stg_enrollment_by_risk_group": 6,
    "stg_enrollment_by_county": 7,
    "stg_chip_enrollment": 6,
    "stg_htw_caseload": 5,
    "stg_timeliness_medicaid": 11,
    "stg_mco_enrollment_by_sda": 9,
    "mart_enrollment_trends": 8,
    "mart_enrollment_by_county": 11,
    "mart_timeliness_performance": 11,
    "mart_chip_enrollment": 7,
    "mart_htw_caseload": 6,
    "mart_mco_enrollment": 13,
}


def test_the_checks_of_each_model_are_pinned(spark, built):
    """Counts of declared checks and grains, and all that the documentation adds."""
    report = check_models(spark).collect()
    added = {"in_range", "shares_sum_to_one", "relationship", "single_value"}
    counts, documented = {}, set()
    for r in report:
        if r.check in added:
            documented.add((r.dataset, r.check, r.column))
        else:
            counts[r.dataset] = counts.get(r.dataset, 0) + 1
    assert counts == PINNED
    assert documented == {
        ("mart_timeliness_performance", "in_range", "pct_timely"),
        ("mart_timeliness_performance", "in_range", "src_percent"),
        ("mart_chip_enrollment", "in_range", "renewal_rate"),
        ("mart_chip_enrollment", "in_range", "disenrollment_rate"),
        ("mart_mco_enrollment", "in_range", "mco_share_of_sda"),
        ("mart_mco_enrollment", "in_range", "mco_share_of_program"),
        ("mart_mco_enrollment", "shares_sum_to_one", "mco_share_of_sda"),
        ("mart_mco_enrollment", "shares_sum_to_one", "mco_share_of_program"),
        ("mart_mco_enrollment", "single_value", "fiscal_year"),
        ("mart_enrollment_trends", "relationship", "report_month, risk_group"),
        ("mart_enrollment_by_county", "relationship", "report_month, county_code, risk_group"),
        ("mart_timeliness_performance", "relationship", "report_month, region, record_type"),
        ("mart_chip_enrollment", "relationship", "report_month"),
        ("mart_htw_caseload", "relationship", "report_month"),
        ("mart_mco_enrollment", "relationship", "mco_name, program, sub_program, sda"),
    }
