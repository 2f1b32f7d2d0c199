"""Profiles of a table: fractional values, frequencies, distinct values, last periods."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import has_fraction, ratio


def fractional_profile(
    df: DataFrame, period: str, columns: Sequence[str] | None = None
) -> DataFrame:
    """Per numeric column: does it hold fractions, and since which period?

    A first period in mid-series gives away a change of counting method. All columns are
    profiled in one pass.
    """
    if columns is None:
        columns = [
            f.name
            for f in df.schema.fields
            if f.dataType.typeName() in ("double", "float", "decimal", "integer", "long")
            and f.name != period
        ]
    seen = df.agg(
        *[F.bool_or(has_fraction(c)).alias(f"any_{i}") for i, c in enumerate(columns)],
        *[
            F.min(F.when(has_fraction(c), F.col(period))).alias(f"first_{i}")
            for i, c in enumerate(columns)
        ],
    )
    lines = [
        F.struct(
            F.lit(c).alias("column"),
            F.coalesce(f"any_{i}", F.lit(False)).alias("fractional"),
            F.col(f"first_{i}").alias("first_occurrence"),
        )
        for i, c in enumerate(columns)
    ]
    return seen.select(F.inline(F.array(*lines)))


def value_counts(
    df: DataFrame, column: str, *, weight: str | None = None, ordered: bool = True
) -> DataFrame:
    """How often each value occurs, most frequent first; missing values are left out.

    `ordered=False` saves the sort where the result goes on into another frame.
    """
    counts = group_sizes(df.where(F.col(column).isNotNull()), column, weight=weight)
    return counts.orderBy(F.desc("count"), column) if ordered else counts


def group_sizes(df: DataFrame, *columns: str, weight: str | None = None) -> DataFrame:
    """Rows per group; `weight` is a column with the rows that each row stands for."""
    rows = F.count(F.lit(1)) if weight is None else F.sum(weight)
    return df.groupBy(*columns).agg(rows.alias("count"))


def distinct_values(df: DataFrame, column: str, *, ordered: bool = True) -> DataFrame:
    values = df.select(column).distinct()
    return values.orderBy(column) if ordered else values


def distinct_count(df: DataFrame, *columns: str, approximate: bool = False) -> DataFrame:
    """One row with the number of distinct values of each column."""
    count = F.approx_count_distinct if approximate else F.count_distinct
    return df.agg(*[count(c).alias(c) for c in columns])


def describe_schema(df: DataFrame) -> DataFrame:
    """Columns and types as rows."""
    rows = [(f.name, f.dataType.simpleString()) for f in df.schema.fields]
    return df.sparkSession.createDataFrame(rows, "column STRING, type STRING")


def profile_columns(df: DataFrame) -> DataFrame:
    """Columns, types, and how many rows have a value and how many none, in one pass."""
    fields = df.schema.fields
    counted = df.agg(
        F.count(F.lit(1)).alias("rows"), *[F.count(f.name).alias(f"n{i}") for i, f in enumerate(fields)]
    )
    lines = [
        F.struct(
            F.lit(f.name).alias("column"),
            F.lit(f.dataType.simpleString()).alias("type"),
            F.col(f"n{i}").alias("n_present"),
            (F.col("rows") - F.col(f"n{i}")).alias("n_missing"),
        )
        for i, f in enumerate(fields)
    ]
    return counted.select(F.inline(F.array(*lines)))


def last_rows(df: DataFrame, order: Sequence[str], n: int) -> DataFrame:
    """The last n rows in ascending order, without sorting the whole frame."""
    return df.orderBy(*[F.desc(c) for c in order]).limit(n).orderBy(*order)


def first_rows(df: DataFrame, order: Sequence[str], n: int) -> DataFrame:
    return df.orderBy(*order).limit(n)


def ratio_by_period(
    df: DataFrame, top: str, bottom: str, period: str, name: str = "ratio"
) -> DataFrame:
    """Two series and their ratio; NULL where the second is zero."""
    return df.select(period, top, bottom, ratio(top, bottom, on_zero="null").alias(name))
