"""The driver's tables, and small helpers shared by the queries on them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


# Declared, so that no footer has to be read before a query is planned.
SCHEMAS = {
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "customer": (
        "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING"
    ),
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE",
    "part": (
        "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, "
        "p_retailprice DOUBLE"
    ),
    "orders": (
        "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
        "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING"
    ),
    "lineitem": (
        "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, "
        "l_quantity DOUBLE, l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, "
        "l_returnflag STRING, l_linestatus STRING, l_shipdate TIMESTAMP_NTZ"
    ),
    "events": (
        "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, "
        "props STRING"
    ),
    "documents": "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT",
    "labels": "doc_id BIGINT, quality INT, toxic INT",
    "conversations": "conv_id BIGINT, turn BIGINT, role STRING, text STRING",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def month_of(column: str) -> Column:
    """First day of the month. Through a date, so that no time zone plays a part."""
    return F.trunc(F.col(column).cast("date"), "month")


def cents(column: str) -> Column:
    """Money as whole cents: sums are exact, in any order, and stay in whole-stage codegen.

    `floor` works on the double itself, where `round` would make a decimal of every value.
    """
    return F.floor(F.col(column) * 100 + 0.5)


def money_sum(column: str) -> Column:
    return F.sum(cents(column)) / F.lit(100.0)




def div0(top: str, bottom: str) -> str:
    """SQL text of a quotient that is 0 over a zero and NULL over or under a NULL."""
    return (
        f"(CASE WHEN ({top}) IS NULL OR ({bottom}) IS NULL THEN NULL "
        f"WHEN ({bottom}) = 0 THEN 0.0 "
        f"ELSE CAST(({top}) AS DOUBLE) / CAST(({bottom}) AS DOUBLE) END)"
    )


def supplied_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quantity by supplier and part: a busy part is one row per supplier before it is joined."""
    return (
        table(spark, sf_dir, "lineitem")
        .groupBy("l_suppkey", "l_partkey")
        .agg(F.sum("l_quantity").alias("quantity"))
    )
