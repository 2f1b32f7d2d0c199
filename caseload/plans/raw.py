"""Landed sheets to the six raw tables: a faithful copy of each sheet's data rows."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.labels import flag_in
from ..functions.names import month_from_name
from ..functions.scalars import clean_text, date_to_epoch_micros, number_or_null, strip
from ..operators.reshape import block_cells, block_rows, cell, stack_sections, under_header
from ..operators.rows import drop_any_value, integer_key

# Sheet layouts, column names, codes and labels of the published tables.
RISK_GROUP_HEADER_ROW = 2
CHIP_HEADER_ROW = 1
HTW_HEADER_ROW = 0
RISK_GROUP_COLUMNS = [
    "medicaid_caseload",
    "aged_and_medicare_related",
    "disability_related",
    "parents",
    "pregnant_women",
    "breast_and_cervical_cancer",
    "childrens_medicaid_risk_group",
    "medicaid_clients_under_21",
    "medicaid_clients_21_and_older",
    "childrens_medicaid_chip_group",
    "regular_chip",
]
RISK_GROUP_RENAMES = {
    "childrens_medicaid": "childrens_medicaid_risk_group",
    "childrens_medicaid_1": "childrens_medicaid_chip_group",
}
CHIP_COLUMNS = ["chip_caseload", "new_enrollment", "renewals", "disenrollment"]
HTW_RENAMES = {"healthy_texas_women_caseload": "month", "unnamed:_1": "caseload"}
COUNTY_CODE = "hhsc_county_code"
COUNTY_COLUMNS = [
    COUNTY_CODE,
    "county",
    "medicaid_caseload",
    "aged_and_medicare_related",
    "disability_related",
    "parents",
    "pregnant_women",
    "breast_and_cervical_cancer",
    "childrens_medicaid",
    "medicaid_clients_under_21",
    "medicaid_clients_21_and_older",
]
COUNTY_HEADER_ROW = 2
TIMELINESS_TABLES = ["applications", "redeterminations"]
TIMELINESS_KEY = "region"
TIMELINESS_MEASURES = ["disposed", "timely", "percent"]
GEOGRAPHIC_REGIONS = ["01", "02/09", "03", "04", "05", "06", "07", "08", "10", "11"]
MCO_HEADER_ROW, MCO_FIRST_ROW, MCO_CLOSING = 1, 2, "Statewide"
MCO_ROW_LABELS = [
    {"program": "TOTAL", "sub_program": "TOTAL"},
    {"program": "CHIP", "sub_program": "TOTAL"},
    {"program": "CHIP", "sub_program": "Regular"},
    {"program": "CHIP", "sub_program": "Perinatal"},
    {"program": "MEDICAID", "sub_program": "TOTAL"},
    {"program": "MEDICAID", "sub_program": "STAR"},
    {"program": "MEDICAID", "sub_program": "STAR+Plus"},
    {"program": "MEDICAID", "sub_program": "Dual Demo"},
    {"program": "MEDICAID", "sub_program": "STAR Health"},
    {"program": "MEDICAID", "sub_program": "STAR Kids"},
]
MCO_ENROLLMENT_TYPE, MCO_FISCAL_YEAR = "sfy_monthly_average", 2025


@dataclass(frozen=True)
class RawTable:
    """How a raw table comes from landed sheets.

    `judge` gives all rows under a header, each with the `reason` why it is not loaded, if there is
    one; `load` makes the table from the rows without a reason, with the columns of `keep` behind.
    """

    judge: Callable[[DataFrame], DataFrame]
    load: Callable[..., DataFrame]

    def __call__(self, grid: DataFrame, **given) -> DataFrame:
        return self.load(self.judge(grid).where("reason IS NULL"), **given)


def _judge_series(header_row: int, month: str) -> Callable[[DataFrame], DataFrame]:
    """Of a sheet with one row per month: rows whose month cell is no date are notes."""

    def judge(grid: DataFrame) -> DataFrame:
        no_date = F.when(_day(month).isNull(), "no date in the month cell")
        return under_header(grid, header_row).withColumn(
            "reason", F.when(_is_blank(), "blank row").otherwise(no_date)
        )

    return judge


def _judge_county(grid: DataFrame) -> DataFrame:
    """Rows without a county's number are totals or notes."""
    body = grid.where(F.col("row_idx") > COUNTY_HEADER_ROW)
    return body.withColumn(
        "reason",
        F.when(_is_blank(), "blank row")
        .when(F.size("cells") != len(COUNTY_COLUMNS), f"not {len(COUNTY_COLUMNS)} columns")
        .when(integer_key(F.get("cells", F.lit(0))).isNull(), "no county code"),
    )


def _judge_timeliness(grid: DataFrame) -> DataFrame:
    """Rows of both tables; a sheet whose name gives no month has none to load."""
    rows = stack_sections(grid, TIMELINESS_TABLES, TIMELINESS_KEY)
    month = month_from_name("source_file", on_unknown="skip")
    unknown = F.when(F.col("month").isNull(), "no month in the name")
    return rows.withColumn("month", month).withColumn("reason", F.coalesce(unknown, "reason"))


def judge_plan_matrix(closing: str = MCO_CLOSING) -> Callable[[DataFrame], DataFrame]:
    """Rows of the plan-by-area matrix, up to its closing label."""
    return lambda grid: block_rows(
        grid, header_row=MCO_HEADER_ROW, first_row=MCO_FIRST_ROW, height=len(MCO_ROW_LABELS), closing=closing
    )


def _load_risk_group(rows: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    return rows.select(_month_cell("month"), *_number_cells(RISK_GROUP_COLUMNS, RISK_GROUP_RENAMES), *keep)


def _load_chip(rows: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    return rows.select(_month_cell("month"), *_number_cells(CHIP_COLUMNS), *keep)


def _load_htw(rows: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    month, caseload = HTW_RENAMES
    return rows.select(_month_cell(month), *_number_cells(["caseload"], {caseload: "caseload"}), *keep)


def _load_county(rows: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    code, county, *measures = COUNTY_COLUMNS
    cells = {name: F.get("cells", F.lit(i)) for i, name in enumerate(COUNTY_COLUMNS)}
    return rows.select(
        integer_key(cells[code]).alias(code),
        cells[county].alias(county),
        *[number_or_null(cells[name]).alias(name) for name in measures],
        date_to_epoch_micros(month_from_name("source_file")).alias("report_month"),
        *keep,
    )


def _load_timeliness(rows: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    return rows.select(
        cell("region").alias("region"),
        *_number_cells(TIMELINESS_MEASURES),
        "record_type",
        date_to_epoch_micros("month").alias("report_month"),
        flag_in(cell("region"), GEOGRAPHIC_REGIONS).alias("is_geographic_region"),
        *keep,
    )


def _load_plans(
    rows: DataFrame, keep: Sequence[str] = (), fiscal_year: int = MCO_FISCAL_YEAR
) -> DataFrame:
    cells = block_cells(rows, labels=MCO_ROW_LABELS, block="mco_name", column="sda", value="enrollment")
    parts = drop_any_value(cells, {"program": "TOTAL", "sub_program": "TOTAL"})
    return parts.select(
        clean_text("mco_name").alias("mco_name"),
        "program",
        "sub_program",
        "sda",
        number_or_null("enrollment").alias("enrollment"),
        F.lit(MCO_ENROLLMENT_TYPE).alias("enrollment_type"),
        F.lit(fiscal_year).cast("bigint").alias("fiscal_year"),
        "source_file",
        *[name for name in keep if name != "source_file"],
    )


#: Month and eleven measures; the derived total of the child groups is left out.
enrollment_by_risk_group = RawTable(_judge_series(RISK_GROUP_HEADER_ROW, "month"), _load_risk_group)
#: Month and four measures.
chip_enrollment_detail = RawTable(_judge_series(CHIP_HEADER_ROW, "month"), _load_chip)
#: Month and caseload, under a title and a blank header.
htw_enrollment = RawTable(_judge_series(HTW_HEADER_ROW, next(iter(HTW_RENAMES))), _load_htw)
#: County rows of all monthly sheets, columns named by position, month from the name.
enrollment_by_county = RawTable(_judge_county, _load_county)
#: Both tables of all monthly sheets; sheets without a month in their name are skipped.
timeliness_medicaid = RawTable(_judge_timeliness, _load_timeliness)
#: Cells of the plan-by-area matrix, derived total rows left out; takes the `fiscal_year`.
mco_enrollment_by_sda = RawTable(judge_plan_matrix(), _load_plans)


def _is_blank() -> Column:
    return ~F.exists("cells", lambda c: F.coalesce(strip(c) != "", F.lit(False)))


def _day(name: str) -> Column:
    return F.substring(cell(name), 1, 10).try_cast("date")


def _month_cell(name: str) -> Column:
    return date_to_epoch_micros(_day(name)).alias("month")


def _number_cells(names: Sequence[str], renames: Mapping[str, str] | None = None) -> list[Column]:
    """Measures by name; `renames` maps a header name to the table's, and others stay."""
    header = {new: old for old, new in (renames or {}).items()}
    return [number_or_null(cell(header.get(name, name))).alias(name) for name in names]
