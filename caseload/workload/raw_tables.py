"""The six raw tables, in their published schemas, derived from the driver's tables.

Each comes with the SQL that derives the same rows. Months are moved to the years in which the
counting methods change, so that the labels of the staging layer take all their values.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.labels import flag_in
from ..functions.scalars import date_to_epoch_micros
from ..plans.raw import COUNTY_CODE, GEOGRAPHIC_REGIONS
from .tables import cents, month_of, supplied_parts, table

MONTHS_LATER = 292  # 1995-01 becomes 2019-05, and 2001-08 becomes 2025-12
REGION_OF_LINE = {1: "01", 2: " 02/09 ", 3: "03", 4: "MEPD", 5: "TOTAL", 6: "ST OFFICE "}
PROGRAM_OF_TYPE = {
    "ECONOMY": ("CHIP", "Regular"),
    "LARGE": ("CHIP", "Perinatal"),
    "MEDIUM": ("MEDICAID", "STAR"),
    "PROMO": ("MEDICAID", "STAR+Plus"),
    "SMALL": ("MEDICAID", "Dual Demo"),
    "STANDARD": ("MEDICAID", "STAR Kids"),
}


def later_month(column: str) -> Column:
    return F.add_months(month_of(column), MONTHS_LATER)


def _count(condition: Column) -> Column:
    return F.count_if(condition).cast("double")


def _or_missing(count: Column) -> Column:
    return F.nullif(count, F.lit(0.0))


def risk_group_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders by month, with eleven measures side by side."""
    priority, status = F.col("o_orderpriority"), F.col("o_orderstatus")
    low, price = priority == "5-LOW", F.col("o_totalprice")
    return (
        table(spark, sf_dir, "orders")
        .groupBy(later_month("o_orderdate").alias("day"))
        .agg(
            F.count(F.lit(1)).cast("double").alias("medicaid_caseload"),
            _count(priority == "1-URGENT").alias("aged_and_medicare_related"),
            _count(priority == "2-HIGH").alias("disability_related"),
            _count(priority == "3-MEDIUM").alias("parents"),
            _count(priority == "4-NOT SPECIFIED").alias("pregnant_women"),
            _or_missing(_count(low & (status == "P"))).alias("breast_and_cervical_cancer"),
            _count(low & (status != "P")).alias("childrens_medicaid_risk_group"),
            _or_missing(_count(price < 5000)).alias("medicaid_clients_under_21"),
            _count(price >= 5000).alias("medicaid_clients_21_and_older"),
            (F.sum(cents("o_totalprice")) / F.lit(100000.0)).alias("childrens_medicaid_chip_group"),
            _count(status == "O").alias("regular_chip"),
        )
    )


RISK_GROUP_MONTHS = f"""
  SELECT CAST(date_trunc('month', o_orderdate) + INTERVAL {MONTHS_LATER} MONTH AS DATE) AS day,
    CAST(count(*) AS DOUBLE) AS medicaid_caseload,
    CAST(count(*) FILTER (WHERE o_orderpriority = '1-URGENT') AS DOUBLE)
      AS aged_and_medicare_related,
    CAST(count(*) FILTER (WHERE o_orderpriority = '2-HIGH') AS DOUBLE) AS disability_related,
    CAST(count(*) FILTER (WHERE o_orderpriority = '3-MEDIUM') AS DOUBLE) AS parents,
    CAST(count(*) FILTER (WHERE o_orderpriority = '4-NOT SPECIFIED') AS DOUBLE) AS pregnant_women,
    nullif(CAST(count(*) FILTER (WHERE o_orderpriority = '5-LOW' AND o_orderstatus = 'P')
      AS DOUBLE), 0) AS breast_and_cervical_cancer,
    CAST(count(*) FILTER (WHERE o_orderpriority = '5-LOW' AND o_orderstatus <> 'P') AS DOUBLE)
      AS childrens_medicaid_risk_group,
    nullif(CAST(count(*) FILTER (WHERE o_totalprice < 5000) AS DOUBLE), 0)
      AS medicaid_clients_under_21,
    CAST(count(*) FILTER (WHERE o_totalprice >= 5000) AS DOUBLE) AS medicaid_clients_21_and_older,
    CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS DOUBLE) / 100000.0
      AS childrens_medicaid_chip_group,
    CAST(count(*) FILTER (WHERE o_orderstatus = 'O') AS DOUBLE) AS regular_chip
  FROM orders GROUP BY ALL"""


def chip_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders by month as a stock, and by status as flows."""
    status = F.col("o_orderstatus")
    return (
        table(spark, sf_dir, "orders")
        .groupBy(later_month("o_orderdate").alias("day"))
        .agg(
            F.count(F.lit(1)).cast("double").alias("chip_caseload"),
            _count(status == "O").alias("new_enrollment"),
            _count(status == "P").alias("renewals"),
            _count(status == "F").alias("disenrollment"),
        )
    )


CHIP_MONTHS = f"""
  SELECT CAST(date_trunc('month', o_orderdate) + INTERVAL {MONTHS_LATER} MONTH AS DATE) AS day,
    CAST(count(*) AS DOUBLE) AS chip_caseload,
    CAST(count(*) FILTER (WHERE o_orderstatus = 'O') AS DOUBLE) AS new_enrollment,
    CAST(count(*) FILTER (WHERE o_orderstatus = 'P') AS DOUBLE) AS renewals,
    CAST(count(*) FILTER (WHERE o_orderstatus = 'F') AS DOUBLE) AS disenrollment
  FROM orders GROUP BY ALL"""


def htw_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line quantity by month, a seventh of it."""
    return (
        table(spark, sf_dir, "lineitem")
        .groupBy(later_month("l_shipdate").alias("day"))
        .agg((F.sum("l_quantity") / F.lit(7.0)).alias("caseload"))
    )


HTW_MONTHS = f"""
  SELECT CAST(date_trunc('month', l_shipdate) + INTERVAL {MONTHS_LATER} MONTH AS DATE) AS day,
    sum(l_quantity) / 7.0 AS caseload
  FROM lineitem GROUP BY ALL"""


def county_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders by month and nation of the customer; the last nation is the unknown county."""
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    nations = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    segment, status = F.col("c_mktsegment"), F.col("o_orderstatus")
    dear = F.col("o_totalprice") >= 450000
    months = (
        table(spark, sf_dir, "orders")
        .join(customers, F.col("o_custkey") == F.col("c_custkey"))
        .groupBy(later_month("o_orderdate").alias("day"), "c_nationkey")
        .agg(
            F.count(F.lit(1)).cast("double").alias("medicaid_caseload"),
            _count(segment == "AUTOMOBILE").alias("aged_and_medicare_related"),
            _count(segment == "BUILDING").alias("disability_related"),
            (_count(segment == "FURNITURE") / F.lit(2.0)).alias("parents"),
            _count(segment == "HOUSEHOLD").alias("pregnant_women"),
            _count((segment == "MACHINERY") & (status == "P")).alias("breast_and_cervical_cancer"),
            _count((segment == "MACHINERY") & (status != "P")).alias("childrens_medicaid"),
            _or_missing(_count(dear)).alias("medicaid_clients_under_21"),
            _count(~dear).alias("medicaid_clients_21_and_older"),
        )
    )
    key = F.col("c_nationkey")
    return months.join(nations, F.col("n_nationkey") == key).select(
        F.when(key == 24, 255).otherwise(key + 1).cast("bigint").alias(COUNTY_CODE),
        F.concat(F.lit(" "), "n_name", F.lit(" ")).alias("county"),
        *months.columns[2:],
        "day",
    )


COUNTY_MONTHS = f"""
  SELECT CAST(CASE WHEN c_nationkey = 24 THEN 255 ELSE c_nationkey + 1 END AS BIGINT)
      AS {COUNTY_CODE},
    ' ' || n_name || ' ' AS county,
    CAST(count(*) AS DOUBLE) AS medicaid_caseload,
    CAST(count(*) FILTER (WHERE c_mktsegment = 'AUTOMOBILE') AS DOUBLE)
      AS aged_and_medicare_related,
    CAST(count(*) FILTER (WHERE c_mktsegment = 'BUILDING') AS DOUBLE) AS disability_related,
    CAST(count(*) FILTER (WHERE c_mktsegment = 'FURNITURE') AS DOUBLE) / 2.0 AS parents,
    CAST(count(*) FILTER (WHERE c_mktsegment = 'HOUSEHOLD') AS DOUBLE) AS pregnant_women,
    CAST(count(*) FILTER (WHERE c_mktsegment = 'MACHINERY' AND o_orderstatus = 'P') AS DOUBLE)
      AS breast_and_cervical_cancer,
    CAST(count(*) FILTER (WHERE c_mktsegment = 'MACHINERY' AND o_orderstatus <> 'P') AS DOUBLE)
      AS childrens_medicaid,
    nullif(CAST(count(*) FILTER (WHERE o_totalprice >= 450000) AS DOUBLE), 0)
      AS medicaid_clients_under_21,
    CAST(count(*) FILTER (WHERE NOT o_totalprice >= 450000) AS DOUBLE)
      AS medicaid_clients_21_and_older,
    CAST(date_trunc('month', o_orderdate) + INTERVAL {MONTHS_LATER} MONTH AS DATE) AS day
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON n_nationkey = c_nationkey
  GROUP BY ALL"""


def timeliness_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Taxed returns by month, region and record type, with regions as a sheet spells them."""
    regions = F.create_map(*[F.lit(x) for pair in REGION_OF_LINE.items() for x in pair])
    open_line = F.col("l_linestatus") == "O"
    counted = (F.col("l_tax") >= 0.08) & (F.col("l_returnflag") == "R")
    return (
        table(spark, sf_dir, "lineitem")
        .groupBy(
            later_month("l_shipdate").alias("day"),
            F.col("l_linenumber").alias("line"),
            F.when(open_line, "applications").otherwise("redeterminations").alias("record_type"),
        )
        .agg(
            _count(counted).alias("disposed"),
            _count(counted & (F.col("l_discount") <= 0.05)).alias("timely"),
        )
        .withColumn("region", F.try_element_at(regions, "line"))
        .withColumn(
            "percent", F.floor(F.try_divide(F.col("timely") * 1000, "disposed")) / F.lit(1000.0)
        )
    )


_REGION_SQL = " ".join(f"WHEN {n} THEN '{r}'" for n, r in REGION_OF_LINE.items())
TIMELINESS_MONTHS = f"""
  SELECT *, floor(timely * 1000 / nullif(disposed, 0)) / 1000.0 AS percent FROM (
    SELECT CAST(date_trunc('month', l_shipdate) + INTERVAL {MONTHS_LATER} MONTH AS DATE) AS day,
      l_linenumber AS line, CASE l_linenumber {_REGION_SQL} END AS region,
      CASE WHEN l_linestatus = 'O' THEN 'applications' ELSE 'redeterminations' END AS record_type,
      CAST(count(*) FILTER (WHERE l_tax >= 0.08 AND l_returnflag = 'R') AS DOUBLE) AS disposed,
      CAST(count(*) FILTER (WHERE l_tax >= 0.08 AND l_returnflag = 'R' AND l_discount <= 0.05)
        AS DOUBLE) AS timely
    FROM lineitem GROUP BY ALL)"""


def mco_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line quantity by supplier, program (of the part's type) and service area (its brand)."""
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_type")
    labels = F.create_map(
        *[
            x
            for kind, (program, sub) in PROGRAM_OF_TYPE.items()
            for x in (
                F.lit(kind),
                F.struct(F.lit(program).alias("program"), F.lit(sub).alias("sub_program")),
            )
        ]
    )
    return (
        supplied_parts(spark, sf_dir)
        .join(parts, F.col("l_partkey") == F.col("p_partkey"))
        .groupBy("l_suppkey", "p_type", F.col("p_brand").alias("sda"))
        .agg((F.sum("quantity") / F.lit(8.0)).alias("enrollment"))
        .withColumn("label", F.try_element_at(labels, "p_type"))
        .select("l_suppkey", "label.program", "label.sub_program", "sda", "enrollment")
    )


_PROGRAM_SQL = " ".join(f"WHEN '{k}' THEN '{p}'" for k, (p, _) in PROGRAM_OF_TYPE.items())
_SUB_PROGRAM_SQL = " ".join(f"WHEN '{k}' THEN '{s}'" for k, (_, s) in PROGRAM_OF_TYPE.items())
MCO_CELLS = f"""
  SELECT l_suppkey, CASE p_type {_PROGRAM_SQL} END AS program,
    CASE p_type {_SUB_PROGRAM_SQL} END AS sub_program, p_brand AS sda,
    sum(l_quantity) / 8.0 AS enrollment
  FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY ALL"""


def raw_tables(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One raw table in its published schema."""
    if name == "enrollment_by_risk_group":
        return _with_month(risk_group_months(spark, sf_dir))
    if name == "chip_enrollment_detail":
        return _with_month(chip_months(spark, sf_dir))
    if name == "htw_enrollment":
        return _with_month(htw_months(spark, sf_dir))
    if name == "enrollment_by_county":
        months = county_months(spark, sf_dir)
        return months.withColumn("report_month", date_to_epoch_micros("day")).drop("day")
    if name == "timeliness_medicaid":
        listed = timeliness_months(spark, sf_dir).where(~F.col("region").eqNullSafe("TOTAL"))
        return listed.select(
            "region",
            "disposed",
            "timely",
            "percent",
            "record_type",
            date_to_epoch_micros("day").alias("report_month"),
            flag_in("region", GEOGRAPHIC_REGIONS).alias("is_geographic_region"),
        )
    if name == "mco_enrollment_by_sda":
        cells = mco_cells(spark, sf_dir)
        return cells.select(
            F.format_string("Supplier %d", "l_suppkey").alias("mco_name"),
            "program",
            "sub_program",
            "sda",
            "enrollment",
            F.lit("sfy_monthly_average").alias("enrollment_type"),
            F.lit(2025).cast("bigint").alias("fiscal_year"),
        )
    raise KeyError(name)


def _with_month(months: DataFrame) -> DataFrame:
    return months.select(date_to_epoch_micros("day").alias("month"), *months.columns[1:])


_REGION_LIST = ", ".join(f"'{r}'" for r in GEOGRAPHIC_REGIONS)
RAW_SQL = {
    "enrollment_by_risk_group": (
        "SELECT epoch_us(CAST(day AS TIMESTAMP)) AS month, * EXCLUDE (day) "
        f"FROM ({RISK_GROUP_MONTHS})"
    ),
    "chip_enrollment_detail": (
        f"SELECT epoch_us(CAST(day AS TIMESTAMP)) AS month, * EXCLUDE (day) FROM ({CHIP_MONTHS})"
    ),
    "htw_enrollment": (
        f"SELECT epoch_us(CAST(day AS TIMESTAMP)) AS month, * EXCLUDE (day) FROM ({HTW_MONTHS})"
    ),
    "enrollment_by_county": (
        "SELECT * EXCLUDE (day), epoch_us(CAST(day AS TIMESTAMP)) AS report_month "
        f"FROM ({COUNTY_MONTHS})"
    ),
    "timeliness_medicaid": (
        "SELECT region, disposed, timely, percent, record_type, "
        "epoch_us(CAST(day AS TIMESTAMP)) AS report_month, "
        f"coalesce(region IN ({_REGION_LIST}), false) AS is_geographic_region "
        f"FROM ({TIMELINESS_MONTHS}) WHERE region IS DISTINCT FROM 'TOTAL'"
    ),
    "mco_enrollment_by_sda": (
        "SELECT 'Supplier ' || l_suppkey AS mco_name, program, sub_program, sda, enrollment, "
        "'sfy_monthly_average' AS enrollment_type, CAST(2025 AS BIGINT) AS fiscal_year "
        f"FROM ({MCO_CELLS})"
    ),
}
