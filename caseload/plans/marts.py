"""Staging frames to the published tables: no consumer needs to compute a metric again."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import ratio
from ..operators.metrics import (
    period_change,
    rolling_mean,
    share_of,
    stock_flow_variance,
    variance_vs_reported,
)
from .staging import COMPONENT_CATEGORY


def mart_enrollment_trends(staging: DataFrame) -> DataFrame:
    """Change per risk group, and its share of the month's component groups."""
    shared = share_of(
        staging,
        "enrollment_count",
        {"pct_of_total": ["report_month"]},
        component=F.col("risk_group_category") == COMPONENT_CATEGORY,
    )
    changed = period_change(shared, "enrollment_count", "report_month", ["risk_group"])
    return changed.select(*staging.columns, "mom_change", "mom_change_pct", "pct_of_total")


def mart_enrollment_by_county(staging: DataFrame) -> DataFrame:
    """Change per county and risk group, and shares of the county and of the state."""
    shared = share_of(
        staging,
        "enrollment_count",
        {
            "pct_of_county_total": ["report_month", "county_code"],
            "pct_of_state_total": ["report_month", "risk_group"],
        },
        component=F.col("risk_group_category") == COMPONENT_CATEGORY,
        component_shares=["pct_of_county_total"],
    )
    changed = period_change(
        shared, "enrollment_count", "report_month", ["risk_group", "county_code"]
    )
    return changed.select(
        "report_month",
        "county_code",
        "county_name",
        "is_unknown_county",
        "risk_group",
        "risk_group_category",
        "enrollment_count",
        "count_methodology",
        "mom_change",
        "mom_change_pct",
        "pct_of_county_total",
        "pct_of_state_total",
    )


def mart_timeliness_performance(staging: DataFrame) -> DataFrame:
    """Timely fraction recomputed, checked against the source, with change and smoothing."""
    timely = staging.withColumn("pct_timely", ratio("timely", "disposed"))
    variance = variance_vs_reported("pct_timely", "src_percent")
    timely = timely.withColumn("pct_timely_variance", variance)
    series = ["region", "record_type"]
    changed = period_change(
        timely, "pct_timely", "report_month", series, change="mom_change_pct_timely", pct=None
    )
    smooth = rolling_mean(changed, "pct_timely", "rolling_3m_pct_timely", "report_month", series)
    return smooth.select(
        "report_month",
        "region",
        "is_geographic_region",
        "record_type",
        "disposed",
        "timely",
        "untimely",
        "pct_timely",
        "src_percent",
        "pct_timely_variance",
        "mom_change_pct_timely",
        "rolling_3m_pct_timely",
    )


def mart_chip_enrollment(staging: DataFrame) -> DataFrame:
    """Net flow, change, rates, and how far flows explain the change of the caseload."""
    netted = staging.withColumn("net_enrollment", F.col("new_enrollment") - F.col("disenrollment"))
    changed = period_change(
        netted,
        "chip_caseload",
        "report_month",
        change="mom_change_caseload",
        pct="mom_change_pct_caseload",
        single_series=True,
    )
    rated = changed.withColumns(
        {
            "renewal_rate": ratio("renewals", "chip_caseload"),
            "disenrollment_rate": ratio("disenrollment", "chip_caseload"),
        }
    )
    return stock_flow_variance(
        rated,
        "chip_caseload",
        "new_enrollment",
        "disenrollment",
        "report_month",
        single_series=True,
    )


def mart_htw_caseload(staging: DataFrame) -> DataFrame:
    """Change of the caseload."""
    return period_change(
        staging,
        "htw_caseload",
        "report_month",
        change="mom_change_caseload",
        pct="mom_change_pct_caseload",
        single_series=True,
    )


def mart_mco_enrollment(staging: DataFrame, by_year: bool = False) -> DataFrame:
    """Each row's share of its service area and of its program.

    Totals are split by fiscal year only with `by_year`; without it one year is loaded at a
    time, and a check of the model fails where several meet.
    """
    year = ["fiscal_year"] if by_year else []
    shares = {
        "mco_share_of_sda": [*year, "program", "sub_program", "sda"],
        "mco_share_of_program": [*year, "program", "sub_program"],
    }
    return share_of(staging, "enrollment_avg", shares).select(
        "fiscal_year",
        "mco_name",
        "program",
        "sub_program",
        "sda",
        "enrollment_avg",
        "enrollment_type",
        *shares,
    )
