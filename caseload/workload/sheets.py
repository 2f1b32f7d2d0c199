"""Sheets laid out like the published ones, made from the driver's tables, and decoded again.

The SQL side never sees a sheet: it derives the raw tables straight from the driver's tables.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.reshape import decode_blocks
from ..plans import raw
from ..plans.pipeline import RAW
from ..session import shared_folder
from ..sources import grid as landing
from ..sources.sinks import publish_table, read_published, reasons_per_file
from ..sources.workbook import decode_workbooks, pack_workbooks
from .raw_tables import (
    CHIP_MONTHS,
    COUNTY_MONTHS,
    HTW_MONTHS,
    MCO_CELLS,
    RAW_SQL,
    RISK_GROUP_MONTHS,
    TIMELINESS_MONTHS,
    chip_months,
    county_months,
    htw_months,
    mco_cells,
    risk_group_months,
    timeliness_months,
)
from .series import SERIES_TREND, series_trend
from .tables import table

MONTH_IN_NAME = [
    "jan", "feb", "mar", "april", "may", "june", "july", "aug", "sept", "oct", "nov", "dec",
]
RISK_GROUP_HEADER = [
    "Month", "Medicaid Caseload", "Aged & Medicare-Related", "Disability-Related", "Parents*",
    "Pregnant Women", "Breast and Cervical Cancer", "Children’s Medicaid",
    "Medicaid Clients Under 21", "Medicaid Clients 21 and Older", "Children’s Medicaid",
    "Regular CHIP", "Total",
]
CHIP_HEADER = ["Month", "CHIP Caseload", "New Enrollment", "Renewals", "Disenrollment"]
BRANDS = [f"Brand#{i}" for i in range(1, 26)]
SUPPLIERS_PER_SHEET = 64
# Where notes stand: below any month, and below any supplier of a sheet.
NOTES_ROW = 1_000_000


def _texts(columns: Sequence[str]) -> list[Column]:
    return [F.col(c).cast("string") for c in columns]


def _row(row_idx: int, cells: Sequence[str | None]) -> Column:
    texts = F.array(*[F.lit(c).cast("string") for c in cells])
    return F.struct(F.lit(row_idx).alias("row_idx"), texts.alias("cells"))


def _sheet(spark: SparkSession, name: str, data: DataFrame, fixed: Sequence[Column]) -> DataFrame:
    """One sheet: its data rows, and the rows every such sheet has."""
    frame = spark.range(1).select(F.inline(F.array(*fixed)))
    rows = data.select("row_idx", "cells").unionByName(frame)
    return rows.select(
        F.lit(name).alias("source_path"), F.lit(name).alias("source_file"), "row_idx", "cells"
    )


def _sheets(rows: DataFrame, frame: Column) -> DataFrame:
    """Many sheets: per source file, its data rows and the rows every such sheet has.

    A sheet is put together as a whole, and has no more rows than its layout.
    """
    whole = rows.groupBy("source_file", "day").agg(
        F.collect_list(F.struct("row_idx", "cells")).alias("data"), F.sum("weight").alias("total")
    )
    return whole.select(
        F.col("source_file").alias("source_path"),
        "source_file",
        F.inline(F.concat(F.col("data"), frame)),
    )


def _row_of_month(first_row: int) -> Column:
    return (F.year("day") * 12 + F.month("day") + first_row).cast("int").alias("row_idx")


def _dated_name(prefix: Column | str) -> Column:
    spelled = F.element_at(F.array(*[F.lit(m) for m in MONTH_IN_NAME]), F.month("day"))
    start = F.lit(prefix) if isinstance(prefix, str) else prefix
    return F.concat(start, spelled, F.lit("-"), F.year("day"), F.lit(".xlsx"))


def risk_group_sheet(spark: SparkSession, sf_dir: str) -> DataFrame:
    months = risk_group_months(spark, sf_dir)
    cells = F.array(*_texts(months.columns), F.lit("1"))
    fixed = [
        _row(0, ["Caseload by risk group", *[None] * 12]),
        _row(2, RISK_GROUP_HEADER),
        _row(NOTES_ROW, ["Notes", *[None] * 12]),
    ]
    data = months.select(_row_of_month(3), cells.alias("cells"))
    return _sheet(spark, "risk-group.xlsx", data, fixed)


def chip_sheet(spark: SparkSession, sf_dir: str) -> DataFrame:
    months = chip_months(spark, sf_dir)
    data = months.select(_row_of_month(2), F.array(*_texts(months.columns)).alias("cells"))
    fixed = [_row(1, CHIP_HEADER), _row(NOTES_ROW, ["Note: final", *[None] * 4])]
    return _sheet(spark, "chip.xlsx", data, fixed)


def htw_sheet(spark: SparkSession, sf_dir: str) -> DataFrame:
    months = htw_months(spark, sf_dir)
    data = months.select(_row_of_month(1), F.array(*_texts(months.columns)).alias("cells"))
    fixed = [_row(0, ["Healthy Texas Women Caseload", None]), _row(NOTES_ROW, ["Note", None])]
    return _sheet(spark, "htw.xlsx", data, fixed)


def county_sheets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One sheet per month: a header, a row per county, a total and footnotes."""
    months = county_months(spark, sf_dir)
    total = F.array(F.lit("TOTAL"), F.lit(None), F.col("total").cast("string"), *[F.lit(None)] * 8)
    frame = F.array(
        _row(2, [f"Column {i}" for i in range(11)]),
        F.struct(F.lit(300).alias("row_idx"), total.alias("cells")),
        _row(302, ["* NaN", *[None] * 10]),
        _row(303, ["1d", *[None] * 10]),
        _row(304, ["7", "a row of another width"]),
    )
    rows = months.select(
        _dated_name("enrollment-by-county-final-").alias("source_file"),
        "day",
        (F.col(raw.COUNTY_CODE) + 3).cast("int").alias("row_idx"),
        F.array(*_texts(months.columns[:-1])).alias("cells"),
        F.col("medicaid_caseload").alias("weight"),
    )
    return _sheets(rows, frame)


def timeliness_sheets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One sheet per month with two tables; sheets of even months order their columns otherwise."""
    months = timeliness_months(spark, sf_dir)
    named = F.when(F.col("day") < "2019-07-01", "timeliness-summary-").otherwise(
        "timeliness-medicaid-"
    )
    usual = ["region", "disposed", "timely", "percent"]
    other = ["region", "percent", "timely", "disposed"]
    even = F.month("day") % 2 == 0
    first_row = F.when(F.col("record_type") == "applications", 4).otherwise(26)
    rows = months.select(
        _dated_name(named).alias("source_file"),
        "day",
        (first_row + F.col("line")).cast("int").alias("row_idx"),
        F.when(even, F.array(*_texts(other))).otherwise(F.array(*_texts(usual))).alias("cells"),
        F.col("disposed").alias("weight"),
    )

    def header(row_idx: int) -> Column:
        reordered, plain = (
            F.array(*[F.lit(c.title()) for c in names]) for names in (other, usual)
        )
        cells = F.when(even, reordered).otherwise(plain)
        return F.struct(F.lit(row_idx).alias("row_idx"), cells.alias("cells"))

    total = F.array(F.lit("TOTAL"), *[F.col("total").cast("string")] * 3).alias("cells")
    frame = F.array(
        _row(0, ["Timeliness", None, None, None]),
        header(3),
        F.struct(F.lit(23).alias("row_idx"), total),
        header(25),
        F.struct(F.lit(45).alias("row_idx"), total),
    )
    return _sheets(rows, frame)


def mco_sheets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sheets of a header with the brands, ten rows per supplier, and a closing line.

    The rows that name suppliers, the headers and the closing lines come from the suppliers alone.
    """
    offset = F.create_map(
        *[
            F.lit(x)
            for i, label in enumerate(raw.MCO_ROW_LABELS)
            if label["sub_program"] != "TOTAL"
            for x in (label["sub_program"], i)
        ]
    )
    height = len(raw.MCO_ROW_LABELS)
    block = raw.MCO_FIRST_ROW + F.pmod("supplier", F.lit(SUPPLIERS_PER_SHEET)) * height
    file = F.format_string("mco-%d.xlsx", F.floor(F.col("supplier") / SUPPLIERS_PER_SHEET))
    cells = (
        mco_cells(spark, sf_dir)
        .groupBy(
            F.col("l_suppkey").alias("supplier"),
            F.try_element_at(offset, F.col("sub_program")).alias("offset"),
        )
        .agg(
            *[
                F.sum(F.when(F.col("sda") == brand, F.col("enrollment"))).alias(f"b{i}")
                for i, brand in enumerate(BRANDS)
            ]
        )
    )
    brands = _texts([f"b{i}" for i in range(len(BRANDS))])
    programs = cells.select(
        file.alias("source_file"),
        (block + F.col("offset")).cast("int").alias("row_idx"),
        F.array(F.lit("program"), *brands, F.lit("9")).alias("cells"),
    )
    suppliers = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("supplier"))
    name = F.format_string("Supplier\n%d ", "supplier")
    names = suppliers.select(
        file.alias("source_file"),
        block.cast("int").alias("row_idx"),
        F.array(name, *[F.lit("1")] * len(BRANDS), F.lit("9")).alias("cells"),
    )
    ends = F.array(
        _row(raw.MCO_HEADER_ROW, [None, *BRANDS, "Total"]),
        _row(NOTES_ROW, [raw.MCO_CLOSING, *["1"] * len(BRANDS), "9"]),
    )
    files = suppliers.select(file.alias("source_file")).distinct()
    frame = names.unionByName(files.select("source_file", F.inline(ends)))
    return programs.unionByName(frame).select(
        F.col("source_file").alias("source_path"), "source_file", "row_idx", "cells"
    )


def raw_risk_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw.enrollment_by_risk_group(risk_group_sheet(spark, sf_dir))


def raw_chip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw.chip_enrollment_detail(chip_sheet(spark, sf_dir))


def raw_htw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw.htw_enrollment(htw_sheet(spark, sf_dir))


def raw_county(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw.enrollment_by_county(county_sheets(spark, sf_dir))


def landed(spark: SparkSession, grid: DataFrame) -> DataFrame:
    """Sheets written to the shared folder, and read from there."""
    folder = shared_folder(spark)
    landing.write_named_grid(grid, folder)
    return landing.read_named_grid(spark, folder)


def raw_timeliness(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw.timeliness_medicaid(timeliness_sheets(spark, sf_dir))


RAW_TIMELINESS = f"""
SELECT * FROM ({RAW_SQL["timeliness_medicaid"]})
WHERE report_month >= epoch_us(TIMESTAMP '2019-07-01')
"""


def raw_mco(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw.mco_enrollment_by_sda(mco_sheets(spark, sf_dir))


_MCO_FILE = f"'mco-' || CAST(l_suppkey // {SUPPLIERS_PER_SHEET} AS VARCHAR) || '.xlsx'"
RAW_MCO = f"""
SELECT 'Supplier ' || l_suppkey AS mco_name, program, sub_program, sda, enrollment,
  'sfy_monthly_average' AS enrollment_type, CAST(2025 AS BIGINT) AS fiscal_year,
  {_MCO_FILE} AS source_file
FROM ({MCO_CELLS})
"""


def block_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The bare decoder: total rows stay, names and values are still cell text."""
    cells = decode_blocks(
        mco_sheets(spark, sf_dir),
        header_row=raw.MCO_HEADER_ROW,
        first_row=raw.MCO_FIRST_ROW,
        labels=raw.MCO_ROW_LABELS,
        closing=raw.MCO_CLOSING,
        block="name",
        column="brand",
        value="value",
    )
    return cells.drop("source_path").withColumn("value", F.col("value").cast("double"))


BLOCK_DECODE = f"""
SELECT {_MCO_FILE} AS source_file, 'Supplier' || chr(10) || l_suppkey || ' ' AS name,
  program, sub_program, sda AS brand, enrollment AS value
FROM ({MCO_CELLS})
UNION ALL
SELECT {_MCO_FILE}, 'Supplier' || chr(10) || l_suppkey || ' ', 'TOTAL', 'TOTAL', 'Brand#' || i, 1.0
FROM (SELECT s_suppkey AS l_suppkey FROM supplier), range(1, 26) AS brands(i)
"""


def grid_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """County sheets landed in the shared folder, read back from there and loaded."""
    return raw.enrollment_by_county(landed(spark, county_sheets(spark, sf_dir)))


def publish_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A mart published to the shared folder with its audit column, and read from there.

    It replaces an older version, and a later one that fails half-way leaves it in place.
    """
    folder, trend = shared_folder(spark), series_trend(spark, sf_dir)
    older, outcome, broken = (
        publish_table(frame, "trend", path=folder, audit_column="dbt_loaded_at")
        for frame in (
            trend.limit(1).select("report_month"),
            trend,
            trend.withColumn("broken", F.when(F.col("order_value") > 0, F.raise_error(F.lit("broken")))),
        )
    )
    if (older.status, outcome.status, broken.status) != ("loaded", "loaded", "failed"):
        raise RuntimeError(f"{older}, {outcome}, {broken}")
    added = {
        "n_loaded": F.lit(outcome.n_rows).cast("bigint"),
        "audited": F.col("dbt_loaded_at").isNotNull(),
    }
    return read_published(spark, folder).withColumns(added).drop("dbt_loaded_at")


PUBLISH_ROUNDTRIP = f"""
SELECT *, count(*) OVER () AS n_loaded, true AS audited FROM ({SERIES_TREND})
"""


def workbook_county(spark: SparkSession, sf_dir: str) -> DataFrame:
    """County sheets as workbooks, one a month, read and loaded from their bytes.

    All rows of a workbook are as wide as its sheet, so those of another width are left out before.
    """
    grid = county_sheets(spark, sf_dir).where(F.size("cells") == len(raw.COUNTY_COLUMNS))
    books = pack_workbooks(grid, "Summary")
    return raw.enrollment_by_county(decode_workbooks(books, "Summary"))


def workbook_risk_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A sheet of dates and numbers as a workbook, read and loaded from its bytes."""
    books = pack_workbooks(risk_group_sheet(spark, sf_dir))
    return raw.enrollment_by_risk_group(decode_workbooks(books, 0))


def file_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows loaded and not, and why, per sheet of all six tables."""
    sheets = {
        "enrollment_by_risk_group": risk_group_sheet,
        "chip_enrollment_detail": chip_sheet,
        "htw_enrollment": htw_sheet,
        "enrollment_by_county": county_sheets,
        "timeliness_medicaid": timeliness_sheets,
        "mco_enrollment_by_sda": mco_sheets,
    }
    reports = [
        reasons_per_file(RAW[name].judge(sheet(spark, sf_dir)), name) for name, sheet in sheets.items()
    ]
    return reduce(DataFrame.unionByName, reports)


_SPELLED = "['" + "', '".join(MONTH_IN_NAME) + "'][month(day)] || '-' || year(day) || '.xlsx'"
_TIMELINESS_FILE = (
    "CASE WHEN day < DATE '2019-07-01' THEN 'timeliness-summary-' ELSE 'timeliness-medicaid-' END || "
    + _SPELLED
)


def _series_lines(table_name: str, file: str, months: str) -> str:
    return f"""
SELECT '{table_name}' AS "table", '{file}' AS file, 'loaded' AS status,
  (SELECT count(*) FROM ({months})) AS n_rows, '' AS message
UNION ALL SELECT '{table_name}', '{file}', 'skipped', 1, 'no date in the month cell'"""


FILE_REPORT = f"""
WITH c AS (SELECT day, count(*) AS n FROM ({COUNTY_MONTHS}) GROUP BY ALL),
t AS (
  SELECT day, count(*) FILTER (WHERE region = 'TOTAL') AS totals, count(*) AS n
  FROM ({TIMELINESS_MONTHS}) GROUP BY ALL
),
-- Lines stand from the row under the header on; the first of them is directly under it.
u AS (
  SELECT *, {_TIMELINESS_FILE} AS file, day >= DATE '2019-07-01' AS dated FROM t
)
{_series_lines("enrollment_by_risk_group", "risk-group.xlsx", RISK_GROUP_MONTHS)}
UNION ALL {_series_lines("chip_enrollment_detail", "chip.xlsx", CHIP_MONTHS)}
UNION ALL {_series_lines("htw_enrollment", "htw.xlsx", HTW_MONTHS)}
UNION ALL SELECT 'enrollment_by_county', 'enrollment-by-county-final-' || {_SPELLED},
  unnest(['loaded', 'skipped', 'skipped']), unnest([n, 3, 1]),
  unnest(['', 'no county code', 'not 11 columns']) FROM c
UNION ALL SELECT 'timeliness_medicaid', file, 'skipped', n + 2, 'no month in the name'
  FROM u WHERE NOT dated
UNION ALL SELECT 'timeliness_medicaid', file, 'loaded', n - totals, '' FROM u WHERE dated
UNION ALL SELECT 'timeliness_medicaid', file, 'skipped', totals + 2, 'total row'
  FROM u WHERE dated
UNION ALL SELECT 'mco_enrollment_by_sda', {_MCO_FILE}, 'loaded', count(*), '' FROM (
    SELECT DISTINCT l_suppkey, sub_program FROM ({MCO_CELLS})
    UNION ALL SELECT s_suppkey, 'TOTAL' FROM supplier) AS l GROUP BY ALL
UNION ALL SELECT DISTINCT 'mco_enrollment_by_sda', {_MCO_FILE}, 'skipped', 1,
  'after the last block' FROM (SELECT s_suppkey AS l_suppkey FROM supplier)
"""

QUERIES = {
    "raw_enrollment_by_risk_group": (raw_risk_group, RAW_SQL["enrollment_by_risk_group"]),
    "raw_chip_enrollment_detail": (raw_chip, RAW_SQL["chip_enrollment_detail"]),
    "raw_htw_enrollment": (raw_htw, RAW_SQL["htw_enrollment"]),
    "raw_enrollment_by_county": (raw_county, RAW_SQL["enrollment_by_county"]),
    "raw_timeliness_medicaid": (raw_timeliness, RAW_TIMELINESS),
    "raw_mco_enrollment_by_sda": (raw_mco, RAW_MCO),
    "block_decode": (block_decode, BLOCK_DECODE),
    "grid_ingest": (grid_ingest, RAW_SQL["enrollment_by_county"]),
    "workbook_enrollment_by_county": (workbook_county, RAW_SQL["enrollment_by_county"]),
    "workbook_enrollment_by_risk_group": (workbook_risk_group, RAW_SQL["enrollment_by_risk_group"]),
    "publish_roundtrip": (publish_roundtrip, PUBLISH_ROUNDTRIP),
    "file_report": (file_report, FILE_REPORT),
}
