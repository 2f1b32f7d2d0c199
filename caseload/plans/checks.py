"""The checks declared for each staging and mart table, and the unique grain of each."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.quality import (
    Check,
    accepted_values,
    in_range,
    not_null,
    relationship,
    shares_sum_to_one,
    single_value,
    unique,
)

# Columns that must be present, and the values that labels may take.
AUDIT_COLUMN = "dbt_loaded_at"
RECORD_TYPES = ["applications", "redeterminations"]
PROGRAMS = ["CHIP", "MEDICAID"]
SUB_PROGRAMS = [
    "Perinatal", "Regular", "Dual Demo", "STAR", "STAR Health", "STAR Kids", "STAR+Plus",
]
ENROLLMENT_METHODS = ["point_in_time_count", "average_daily_enrollment"]
CASELOAD_METHODS = ["point_in_time_count", "average_daily_caseload"]
REQUIRED = {
    "stg_enrollment_by_risk_group": [
        "report_month", "risk_group", "enrollment_count", "count_methodology",
    ],
    "stg_enrollment_by_county": [
        "report_month", "county_code", "county_name", "risk_group", "enrollment_count",
        "count_methodology",
    ],
    "stg_chip_enrollment": [
        "report_month", "chip_caseload", "new_enrollment", "renewals", "disenrollment",
    ],
    "stg_htw_caseload": ["report_month", "htw_caseload", "count_methodology"],
    "stg_timeliness_medicaid": [
        "report_month", "region", "record_type", "is_geographic_region",
    ],
    "stg_mco_enrollment_by_sda": [
        "mco_name", "program", "sub_program", "sda", "fiscal_year", "enrollment_avg",
        "enrollment_type",
    ],
    "mart_enrollment_trends": [
        "report_month", "risk_group", "risk_group_category", "enrollment_count",
        "count_methodology", AUDIT_COLUMN,
    ],
    "mart_enrollment_by_county": [
        "report_month", "county_code", "county_name", "is_unknown_county", "risk_group",
        "risk_group_category", "enrollment_count", "count_methodology", AUDIT_COLUMN,
    ],
    "mart_timeliness_performance": [
        "report_month", "region", "is_geographic_region", "record_type", "disposed", "timely",
        "untimely", "pct_timely", "src_percent", AUDIT_COLUMN,
    ],
    "mart_chip_enrollment": [
        "report_month", "chip_caseload", "new_enrollment", "renewals", "disenrollment",
        AUDIT_COLUMN,
    ],
    "mart_htw_caseload": ["report_month", "htw_caseload", "count_methodology", AUDIT_COLUMN],
    "mart_mco_enrollment": [
        "fiscal_year", "mco_name", "program", "sub_program", "sda", "enrollment_avg",
        "enrollment_type", "mco_share_of_sda", "mco_share_of_program", AUDIT_COLUMN,
    ],
}
REQUIRED_IN_REGIONS = {
    "stg_timeliness_medicaid": ["disposed", "timely", "untimely", "pct_timely", "src_percent"],
}
ACCEPTED = {
    "stg_enrollment_by_risk_group": {"count_methodology": ENROLLMENT_METHODS},
    "stg_htw_caseload": {"count_methodology": CASELOAD_METHODS},
    "stg_timeliness_medicaid": {"record_type": RECORD_TYPES},
    "stg_mco_enrollment_by_sda": {"program": PROGRAMS},
    "mart_enrollment_trends": {
        "risk_group_category": [
            "caseload_by_risk_group", "caseload_by_age", "childrens_medicaid_and_chip",
        ],
        "count_methodology": ENROLLMENT_METHODS,
    },
    "mart_enrollment_by_county": {
        "risk_group_category": ["caseload_by_risk_group", "caseload_by_age"],
        "count_methodology": ["point_in_time_count"],
    },
    "mart_timeliness_performance": {"record_type": RECORD_TYPES},
    "mart_htw_caseload": {"count_methodology": CASELOAD_METHODS},
    "mart_mco_enrollment": {
        "program": PROGRAMS,
        "sub_program": SUB_PROGRAMS,
        "enrollment_type": ["sfy_monthly_average"],
    },
}
UNIQUE = [
    "stg_chip_enrollment", "stg_htw_caseload", "mart_chip_enrollment", "mart_htw_caseload",
]
# One row per these columns. Metrics that look at the row before rely on it.
GRAIN = {
    "stg_enrollment_by_risk_group": ["report_month", "risk_group"],
    "stg_enrollment_by_county": ["report_month", "county_code", "risk_group"],
    "stg_timeliness_medicaid": ["report_month", "region", "record_type"],
    "stg_mco_enrollment_by_sda": ["mco_name", "program", "sub_program", "sda"],
}
# What the documentation of the models says of them, beyond the declared checks: fractions that
# lie between 0 and 1, shares that sum to one, marts whose keys are those of their staging
# frame, and plans of one fiscal year.
FRACTIONS = {
    "mart_timeliness_performance": ["pct_timely", "src_percent"],
    "mart_chip_enrollment": ["renewal_rate", "disenrollment_rate"],
    "mart_mco_enrollment": ["mco_share_of_sda", "mco_share_of_program"],
}
SHARES = {
    "mart_mco_enrollment": {
        "mco_share_of_sda": ["program", "sub_program", "sda"],
        "mco_share_of_program": ["program", "sub_program"],
    },
}
ORIGINS = {
    "mart_enrollment_trends": ("stg_enrollment_by_risk_group", ["report_month", "risk_group"]),
    "mart_enrollment_by_county": (
        "stg_enrollment_by_county", ["report_month", "county_code", "risk_group"],
    ),
    "mart_timeliness_performance": (
        "stg_timeliness_medicaid", ["report_month", "region", "record_type"],
    ),
    "mart_chip_enrollment": ("stg_chip_enrollment", ["report_month"]),
    "mart_htw_caseload": ("stg_htw_caseload", ["report_month"]),
    "mart_mco_enrollment": (
        "stg_mco_enrollment_by_sda", ["mco_name", "program", "sub_program", "sda"],
    ),
}
SINGLE = {"mart_mco_enrollment": ["fiscal_year"]}


def declared_checks(table: str, with_audit: bool = True) -> list[Check]:
    """The checks of a table; `with_audit=False` for a frame not published yet."""
    required = [c for c in REQUIRED[table] if with_audit or c != AUDIT_COLUMN]
    in_region = F.col("is_geographic_region")
    return [
        *[not_null(c) for c in required],
        *[not_null(c, where=in_region) for c in REQUIRED_IN_REGIONS.get(table, [])],
        *[accepted_values(c, values) for c, values in ACCEPTED.get(table, {}).items()],
        *([unique("report_month")] if table in UNIQUE else []),
    ]


def grain_checks(table: str) -> list[Check]:
    """The composite key of a staging table, which the declared checks leave untested."""
    return [unique(*GRAIN[table])] if table in GRAIN else []


def documented_checks(table: str, staged: Mapping[str, DataFrame]) -> list[Check]:
    """What the documentation says of a mart; `staged` maps staging names to their frames."""
    checks: list[Check] = [in_range(c, 0, 1) for c in FRACTIONS.get(table, [])]
    checks += [shares_sum_to_one(c, *keys) for c, keys in SHARES.get(table, {}).items()]
    if table in ORIGINS:
        origin, keys = ORIGINS[table]
        checks.append(relationship(keys, staged[origin], keys))
    return checks + [single_value(c) for c in SINGLE.get(table, [])]
