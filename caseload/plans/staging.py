"""Raw tables to typed, filtered, long staging frames. All of them are lazy."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.labels import category_map, effective_dated_label
from ..functions.scalars import epoch_micros_to_date, ratio, round_to_long
from ..operators.reshape import wide_to_long
from ..operators.rows import drop_listed
from .raw import COUNTY_CODE

# Groups, categories, labels, dates and codes of the published tables.
COMPONENT_CATEGORY = "caseload_by_risk_group"
RISK_GROUP_CATEGORIES = {
    "caseload_by_risk_group": [
        "aged_and_medicare_related",
        "breast_and_cervical_cancer",
        "disability_related",
        "parents",
        "pregnant_women",
        "childrens_medicaid_risk_group",
    ],
    "caseload_by_age": ["medicaid_clients_under_21", "medicaid_clients_21_and_older"],
    "childrens_medicaid_and_chip": ["childrens_medicaid_chip_group", "regular_chip"],
}
COUNTY_CATEGORIES = {
    "caseload_by_risk_group": [
        "aged_and_medicare_related",
        "breast_and_cervical_cancer",
        "disability_related",
        "parents",
        "pregnant_women",
        "childrens_medicaid",
    ],
    "caseload_by_age": ["medicaid_clients_under_21", "medicaid_clients_21_and_older"],
}
POINT_IN_TIME = "point_in_time_count"
DAILY_ENROLLMENT = "average_daily_enrollment"
DAILY_CASELOAD = "average_daily_caseload"
METHOD_SWITCH = "2025-08-01"
METHOD_SWITCH_BY_GROUP = {"regular_chip": None, "medicaid_clients_under_21": "2025-09-01"}
UNKNOWN_COUNTY = 255
REGIONS_LEFT_OUT = ["MEPD", "ST OFFICE", "UNKNOWN"]


def stg_enrollment_by_risk_group(raw: DataFrame) -> DataFrame:
    """One row per month and risk group, without the grand total."""
    groups = [g for members in RISK_GROUP_CATEGORIES.values() for g in members]
    long = wide_to_long(raw, ["month"], groups, "risk_group", "enrollment_count")
    overrides = {
        group: [(day, DAILY_ENROLLMENT)] if day else []
        for group, day in METHOD_SWITCH_BY_GROUP.items()
    }
    return long.withColumn("report_month", epoch_micros_to_date("month")).select(
        "report_month",
        "risk_group",
        category_map("risk_group", RISK_GROUP_CATEGORIES).alias("risk_group_category"),
        F.col("enrollment_count").cast("double").alias("enrollment_count"),
        effective_dated_label(
            "report_month",
            POINT_IN_TIME,
            [(METHOD_SWITCH, DAILY_ENROLLMENT)],
            group="risk_group",
            overrides=overrides,
        ).alias("count_methodology"),
    )


def stg_enrollment_by_county(raw: DataFrame) -> DataFrame:
    """One row per month, county and risk group, without the grand total."""
    groups = [g for members in COUNTY_CATEGORIES.values() for g in members]
    keys = ["report_month", COUNTY_CODE, "county"]
    long = wide_to_long(raw, keys, groups, "risk_group", "enrollment")
    return long.select(
        epoch_micros_to_date("report_month").alias("report_month"),
        F.col(COUNTY_CODE).alias("county_code"),
        F.trim("county").alias("county_name"),
        "risk_group",
        category_map("risk_group", COUNTY_CATEGORIES).alias("risk_group_category"),
        round_to_long("enrollment").alias("enrollment_count"),
        F.lit(POINT_IN_TIME).alias("count_methodology"),
        (F.col(COUNTY_CODE) == UNKNOWN_COUNTY).alias("is_unknown_county"),
    )


def stg_chip_enrollment(raw: DataFrame) -> DataFrame:
    """One row per month; the measures stay side by side."""
    measures = ["chip_caseload", "new_enrollment", "renewals", "disenrollment"]
    return raw.select(
        epoch_micros_to_date("month").alias("report_month"),
        *[round_to_long(m).alias(m) for m in measures],
    )


def stg_htw_caseload(raw: DataFrame) -> DataFrame:
    """One row per month."""
    typed = raw.select(
        epoch_micros_to_date("month").alias("report_month"),
        F.col("caseload").cast("double").alias("htw_caseload"),
    )
    label = effective_dated_label("report_month", POINT_IN_TIME, [(METHOD_SWITCH, DAILY_CASELOAD)])
    return typed.withColumn("count_methodology", label)


def stg_timeliness_medicaid(raw: DataFrame) -> DataFrame:
    """One row per month, region and record type; `pct_timely` is a rounded percentage."""
    kept = drop_listed(raw, "region", REGIONS_LEFT_OUT)
    return kept.select(
        epoch_micros_to_date("report_month").alias("report_month"),
        F.trim("region").alias("region"),
        F.trim("record_type").alias("record_type"),
        round_to_long("disposed").alias("disposed"),
        round_to_long("timely").alias("timely"),
        (round_to_long("disposed") - round_to_long("timely")).alias("untimely"),
        ratio("timely", "disposed", on_zero="null", scale=100, digits=2).alias("pct_timely"),
        F.col("percent").cast("double").alias("src_percent"),
        F.col("is_geographic_region").cast("boolean").alias("is_geographic_region"),
    )


def stg_mco_enrollment_by_sda(raw: DataFrame) -> DataFrame:
    """One row per plan, program, sub-program and service area; a fiscal year's average."""
    return raw.select(
        *[F.trim(c).alias(c) for c in ("mco_name", "program", "sub_program", "sda")],
        round_to_long("fiscal_year").alias("fiscal_year"),
        F.col("enrollment").cast("double").alias("enrollment_avg"),
        F.trim("enrollment_type").alias("enrollment_type"),
    )
