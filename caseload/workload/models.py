"""The twelve published models on raw tables derived from the driver's tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import partial, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.sql import register_sql_functions
from ..plans.graph import together
from ..plans.pipeline import MARTS, RAW, STAGING, build_models
from ..plans.raw import COUNTY_CODE
from ..sources.sinks import publish_table, publish_view, raise_failed, target_namespace
from .raw_tables import RAW_SQL, raw_tables
from .tables import div0


def staged(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    build, source = STAGING[name]
    return build(raw_tables(spark, sf_dir, source))


def mart(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    build, source = MARTS[name]
    return build(staged(spark, sf_dir, source))


def model(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return staged(spark, sf_dir, name) if name in STAGING else mart(spark, sf_dir, name)


_DATE = "CAST(make_timestamp({}) AS DATE)"
# Published column names.
_COUNTY_VALUES = [
    "aged_and_medicare_related", "disability_related", "parents", "pregnant_women",
    "breast_and_cervical_cancer", "childrens_medicaid", "medicaid_clients_under_21",
    "medicaid_clients_21_and_older",
]
_RISK_VALUES = [
    "aged_and_medicare_related", "disability_related", "parents", "pregnant_women",
    "breast_and_cervical_cancer", "childrens_medicaid_risk_group", "medicaid_clients_under_21",
    "medicaid_clients_21_and_older", "childrens_medicaid_chip_group", "regular_chip",
]

STAGING_SQL = {
    "stg_enrollment_by_risk_group": f"""
SELECT *,
  CASE WHEN risk_group LIKE 'medicaid_clients_%' THEN 'caseload_by_age'
       WHEN risk_group IN ('childrens_medicaid_chip_group', 'regular_chip')
         THEN 'childrens_medicaid_and_chip'
       WHEN risk_group IN ('aged_and_medicare_related', 'breast_and_cervical_cancer', 'disability_related',
         'parents', 'pregnant_women', 'childrens_medicaid_risk_group') THEN 'caseload_by_risk_group'
       END AS risk_group_category,
  CASE WHEN report_month >= (CASE risk_group WHEN 'regular_chip' THEN DATE '9999-12-31'
         WHEN 'medicaid_clients_under_21' THEN DATE '2025-09-01' ELSE DATE '2025-08-01' END)
       THEN 'average_daily_enrollment' ELSE 'point_in_time_count' END AS count_methodology
FROM (
  SELECT {_DATE.format("month")} AS report_month, risk_group, enrollment_count
  FROM ({RAW_SQL["enrollment_by_risk_group"]})
  UNPIVOT (enrollment_count FOR risk_group IN ({", ".join(_RISK_VALUES)})))""",
    "stg_enrollment_by_county": f"""
SELECT {_DATE.format("report_month")} AS report_month, {COUNTY_CODE} AS county_code,
  trim(county) AS county_name, risk_group,
  CASE WHEN risk_group LIKE 'medicaid_clients_%' THEN 'caseload_by_age'
       WHEN risk_group IN ('aged_and_medicare_related', 'breast_and_cervical_cancer', 'disability_related',
         'parents', 'pregnant_women', 'childrens_medicaid') THEN 'caseload_by_risk_group'
       END AS risk_group_category,
  CAST(round(enrollment) AS BIGINT) AS enrollment_count,
  'point_in_time_count' AS count_methodology, {COUNTY_CODE} = 255 AS is_unknown_county
FROM ({RAW_SQL["enrollment_by_county"]})
UNPIVOT (enrollment FOR risk_group IN ({", ".join(_COUNTY_VALUES)}))""",
    "stg_chip_enrollment": f"""
SELECT {_DATE.format("month")} AS report_month,
  CAST(round(chip_caseload) AS BIGINT) AS chip_caseload,
  CAST(round(new_enrollment) AS BIGINT) AS new_enrollment,
  CAST(round(renewals) AS BIGINT) AS renewals,
  CAST(round(disenrollment) AS BIGINT) AS disenrollment
FROM ({RAW_SQL["chip_enrollment_detail"]})""",
    "stg_htw_caseload": f"""
SELECT {_DATE.format("month")} AS report_month, caseload AS htw_caseload,
  CASE WHEN {_DATE.format("month")} >= DATE '2025-08-01' THEN 'average_daily_caseload'
       ELSE 'point_in_time_count' END AS count_methodology
FROM ({RAW_SQL["htw_enrollment"]})""",
    "stg_timeliness_medicaid": f"""
SELECT {_DATE.format("report_month")} AS report_month, trim(region) AS region,
  trim(record_type) AS record_type, CAST(round(disposed) AS BIGINT) AS disposed,
  CAST(round(timely) AS BIGINT) AS timely,
  CAST(round(disposed) AS BIGINT) - CAST(round(timely) AS BIGINT) AS untimely,
  round(timely / nullif(disposed, 0) * 100, 2) AS pct_timely, percent AS src_percent,
  is_geographic_region
FROM ({RAW_SQL["timeliness_medicaid"]})
WHERE trim(region) NOT IN ('MEPD', 'ST OFFICE', 'UNKNOWN')""",
    "stg_mco_enrollment_by_sda": f"""
SELECT trim(mco_name) AS mco_name, trim(program) AS program, trim(sub_program) AS sub_program,
  trim(sda) AS sda, fiscal_year, enrollment AS enrollment_avg,
  trim(enrollment_type) AS enrollment_type
FROM ({RAW_SQL["mco_enrollment_by_sda"]})""",
}

MART_SQL = {
    "mart_enrollment_trends": f"""
WITH s AS ({STAGING_SQL["stg_enrollment_by_risk_group"]}),
t AS (SELECT report_month, sum(enrollment_count) AS total FROM s
      WHERE risk_group_category = 'caseload_by_risk_group' GROUP BY ALL),
l AS (SELECT *, lag(enrollment_count) OVER (PARTITION BY risk_group ORDER BY report_month)
        AS prior FROM s)
SELECT l.* EXCLUDE (prior), enrollment_count - prior AS mom_change,
  {div0("enrollment_count - prior", "prior")} AS mom_change_pct,
  {div0("enrollment_count", "total")} AS pct_of_total
FROM l LEFT JOIN t ON l.report_month = t.report_month""",
    "mart_enrollment_by_county": f"""
WITH s AS ({STAGING_SQL["stg_enrollment_by_county"]}),
ct AS (SELECT report_month, county_code, sum(enrollment_count) AS county_total FROM s
       WHERE risk_group_category = 'caseload_by_risk_group' GROUP BY ALL),
st AS (SELECT report_month, risk_group, sum(enrollment_count) AS state_total FROM s GROUP BY ALL),
l AS (SELECT *, lag(enrollment_count) OVER (
        PARTITION BY risk_group, county_code ORDER BY report_month) AS prior FROM s)
SELECT l.* EXCLUDE (prior), enrollment_count - prior AS mom_change,
  {div0("enrollment_count - prior", "prior")} AS mom_change_pct,
  {div0("enrollment_count", "county_total")} AS pct_of_county_total,
  {div0("enrollment_count", "state_total")} AS pct_of_state_total
FROM l
LEFT JOIN ct ON l.report_month = ct.report_month AND l.county_code = ct.county_code
LEFT JOIN st ON l.report_month = st.report_month AND l.risk_group = st.risk_group""",
    "mart_timeliness_performance": f"""
WITH s AS ({STAGING_SQL["stg_timeliness_medicaid"]}),
r AS (SELECT * EXCLUDE (pct_timely), {div0("timely", "disposed")} AS pct_timely FROM s)
SELECT *, pct_timely - src_percent AS pct_timely_variance,
  pct_timely - lag(pct_timely) OVER w AS mom_change_pct_timely,
  avg(pct_timely) OVER (w ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS rolling_3m_pct_timely
FROM r WINDOW w AS (PARTITION BY region, record_type ORDER BY report_month)""",
    "mart_chip_enrollment": f"""
WITH l AS (SELECT *, lag(chip_caseload) OVER (ORDER BY report_month) AS prior
           FROM ({STAGING_SQL["stg_chip_enrollment"]}))
SELECT * EXCLUDE (prior), new_enrollment - disenrollment AS net_enrollment,
  chip_caseload - prior AS mom_change_caseload,
  {div0("chip_caseload - prior", "prior")} AS mom_change_pct_caseload,
  {div0("renewals", "chip_caseload")} AS renewal_rate,
  {div0("disenrollment", "chip_caseload")} AS disenrollment_rate,
  {div0("chip_caseload - (prior + new_enrollment - disenrollment)", "chip_caseload")}
    AS caseload_reconciliation_variance_pct
FROM l""",
    "mart_htw_caseload": f"""
WITH l AS (SELECT *, lag(htw_caseload) OVER (ORDER BY report_month) AS prior
           FROM ({STAGING_SQL["stg_htw_caseload"]}))
SELECT * EXCLUDE (prior), htw_caseload - prior AS mom_change_caseload,
  {div0("htw_caseload - prior", "prior")} AS mom_change_pct_caseload
FROM l""",
    "mart_mco_enrollment": f"""
WITH s AS ({STAGING_SQL["stg_mco_enrollment_by_sda"]}),
sd AS (SELECT program, sub_program, sda, sum(enrollment_avg) AS sda_total FROM s GROUP BY ALL),
p AS (SELECT program, sub_program, sum(enrollment_avg) AS program_total FROM s GROUP BY ALL)
SELECT s.*, {div0("enrollment_avg", "sda_total")} AS mco_share_of_sda,
  {div0("enrollment_avg", "program_total")} AS mco_share_of_program
FROM s
LEFT JOIN sd ON s.program = sd.program AND s.sub_program = sd.sub_program AND s.sda = sd.sda
LEFT JOIN p ON s.program = p.program AND s.sub_program = p.sub_program""",
}


def sql_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The library from SQL: a published view, and the scalar rules as functions."""
    register_sql_functions(spark)
    publish_view(staged(spark, sf_dir, "stg_chip_enrollment"), "stg_chip_enrollment")
    return spark.sql(
        """
        SELECT report_month, date_to_epoch_micros(report_month) AS month,
          div0(renewals, chip_caseload) AS renewal_rate,
          div0(chip_caseload - before, before) AS growth
        FROM (
          SELECT *, lag(chip_caseload) OVER (ORDER BY report_month) AS before
          FROM stg_chip_enrollment)
        """
    )


SQL_RATES = f"""
SELECT report_month, epoch_us(CAST(report_month AS TIMESTAMP)) AS month,
  {div0("renewals", "chip_caseload")} AS renewal_rate,
  {div0("chip_caseload - before", "before")} AS growth
FROM (SELECT *, lag(chip_caseload) OVER (ORDER BY report_month) AS before
      FROM ({STAGING_SQL["stg_chip_enrollment"]}))
"""


#: A measure of each mart, as it is summed for comparison.
MEASURES = {
    "mart_enrollment_trends": "enrollment_count",
    "mart_enrollment_by_county": "enrollment_count",
    "mart_timeliness_performance": "timely",
    "mart_chip_enrollment": "chip_caseload",
    "mart_htw_caseload": "htw_caseload",
    "mart_mco_enrollment": "enrollment_avg",
}


def catalog_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All marts by way of the catalog: raw tables, views and marts by name, in routed namespaces.

    One row per mart with its rows, the sum of a measure in thousandths, and the rows whose change has no
    row before. The namespaces are new ones, so nothing that a user has is replaced, and are dropped.
    """
    run = uuid.uuid4().hex
    namespaces = {"raw_namespace": f" raw_{run} ", "mart_namespace": f"marts_{run}"}
    target = target_namespace(namespaces["mart_namespace"], "default")
    try:
        raise_failed(
            list(
                together(
                    {
                        name: partial(
                            publish_table, raw_tables(spark, sf_dir, name), name,
                            namespace=namespaces["raw_namespace"], audit_column="loaded_at",
                        )
                        for name in RAW
                    }
                ).values()
            )
        )
        built = {r["table"]: r["n_rows"] for r in build_models(spark, **namespaces).collect()}
        lines = [
            spark.table(f"`{target}`.`{name}`").agg(
                F.lit(name).alias("mart"),
                F.lit(built[name]).cast("bigint").alias("n_loaded"),
                F.count(F.lit(1)).alias("n_rows"),
                F.sum(F.round(F.col(measure) * 1000).cast("bigint")).alias("thousandths"),
            )
            for name, measure in MEASURES.items()
        ]
        rows = reduce(DataFrame.unionByName, lines).collect()
    finally:
        for namespace in namespaces.values():
            spark.sql(f"DROP DATABASE IF EXISTS `{target_namespace(namespace, 'default')}` CASCADE")
    return spark.createDataFrame(rows, "mart STRING, n_loaded BIGINT, n_rows BIGINT, thousandths BIGINT")


CATALOG_MODELS = " UNION ALL ".join(
    f"""
SELECT '{name}' AS mart, count(*) AS n_loaded, count(*) AS n_rows,
  CAST(sum(CAST(round(CAST({measure} AS DOUBLE) * 1000) AS BIGINT)) AS BIGINT) AS thousandths
FROM ({MART_SQL[name]})"""
    for name, measure in MEASURES.items()
)


def _query(name: str) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: model(spark, sf_dir, name)


QUERIES = {name: (_query(name), sql) for name, sql in {**STAGING_SQL, **MART_SQL}.items()}
QUERIES["catalog_models"] = (catalog_models, CATALOG_MODELS)
QUERIES["sql_rates"] = (sql_rates, SQL_RATES)
