"""Summaries of bounded size that are kept in tables: distinct counts of any span, and frequent values."""

from __future__ import annotations

from collections.abc import Sequence
from math import ceil

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Power of two of a distinct sketch's registers: 64 kB at most, and an error of about 0.4 %.
REGISTERS = 16
#: A frequency summary of m counters errs by less than this share of the rows over m.
ERROR = 3.5
#: Rows that each counted value stands for at least, as a part of the asked share.
MARGIN = 0.5


def distinct_sketches(df: DataFrame, value: str, by: Sequence[str]) -> DataFrame:
    """One row per group `by` (a period, say): its keys, n_rows, and a sketch of its distinct values.

    Sketches are built in the map tasks and merged; none grows with the group. Missing values are not
    counted. Publish the frame, and ask `distinct_over` for any span of it.
    """
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_rows"), F.hll_sketch_agg(value, F.lit(REGISTERS)).alias("sketch")
    )


def distinct_over(sketches: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Rows and about how many distinct values, united over all sketches of a group `by`.

    A value in several of them counts once. The detail is not read again.
    """
    united = F.hll_sketch_estimate(F.hll_union_agg("sketch"))
    rows = F.coalesce(F.sum("n_rows"), F.lit(0)).cast("bigint")
    return sketches.groupBy(*by).agg(rows.alias("n_rows"), F.coalesce(united, F.lit(0)).alias("n_distinct"))


def frequent_values(df: DataFrame, column: str, share: float) -> DataFrame:
    """value, n_rows, estimate and max_error of every value that more than `share` of the rows have.

    A summary of a fixed number of counters (ERROR / (share * MARGIN) or more, whatever the number of
    values) is built in the map tasks and merged. It can't miss a frequent value: what it says of one is off
    by `max_error` at most. Its candidates, at most as many as counters, are counted exactly in a second
    read, in which each task sends one row per candidate. Missing values count as rows, not as values.
    """
    counters = 1 << ceil(ERROR / (share * MARGIN) - 1).bit_length()
    tracked = counters * 3 // 4
    total, present = F.count(F.lit(1)), df.where(F.col(column).isNotNull())
    summary = present.agg(
        F.expr(f"approx_top_k(`{column}`, {min(tracked, ceil(counters / ERROR))}, {tracked})").alias("top")
    )
    candidates = summary.select(F.inline("top")).select(
        F.col("item").alias("__value"), F.col("count").cast("bigint").alias("estimate")
    )
    # At most counters / ERROR rows.
    counted = df.join(F.broadcast(candidates), F.col(column) == F.col("__value")).groupBy("__value").agg(
        total.alias("n_rows"), F.max("estimate").alias("estimate")
    )
    whole = df.agg(total.alias("__total"))
    found = counted.withColumn("__total", whole.scalar())
    return found.where(F.col("n_rows") > F.lit(share) * F.col("__total")).select(
        F.col("__value").alias("value"),
        "n_rows",
        "estimate",
        F.ceil(F.lit(ERROR / counters) * F.col("__total")).cast("bigint").alias("max_error"),
    )
