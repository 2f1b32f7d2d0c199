"""The library's scalar rules as SQL functions of a session, inlined by Catalyst."""

from __future__ import annotations

from pyspark.sql import SparkSession

from .scalars import MICROS_PER_DAY

FUNCTIONS = {
    "div0(a DOUBLE, b DOUBLE) RETURNS DOUBLE": (
        "CASE WHEN b = 0 THEN IF(a IS NULL, NULL, 0D) ELSE a / b END"
    ),
    "epoch_micros_to_date(micros BIGINT) RETURNS DATE": (
        f"date_from_unix_date(CAST((micros - pmod(micros, {MICROS_PER_DAY})) "
        f"/ {MICROS_PER_DAY} AS INT))"
    ),
    "date_to_epoch_micros(day DATE) RETURNS BIGINT": (
        f"CAST(unix_date(day) AS BIGINT) * {MICROS_PER_DAY}"
    ),
    "round_to_long(x DOUBLE) RETURNS BIGINT": "CAST(round(x) AS BIGINT)",
}


def register_sql_functions(spark: SparkSession) -> None:
    for signature, body in FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {signature} RETURN {body}")
