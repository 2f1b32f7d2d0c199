"""Row filters whose treatment of missing values is part of the result."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import column, number_or_null


def keep_numeric_key(df: DataFrame, key: str, name: str | None = None) -> DataFrame:
    """Keep rows whose text key is a number (not totals or footnotes), as a long.

    A number that is no long is no key either, see `integer_key`.
    """
    number = integer_key(key)
    return df.where(number.isNotNull()).withColumn(name or key, number)


def integer_key(ref: Column | str) -> Column:
    """A text key as a long; NULL for text that is no number, or one out of range."""
    return number_or_null(ref).try_cast("bigint")


def drop_value(df: DataFrame, ref: Column | str, value: str) -> DataFrame:
    """Drop rows with one value; rows without a value stay."""
    return df.where(~column(ref).eqNullSafe(F.lit(value)))


def drop_any_value(df: DataFrame, values: Mapping[str, str]) -> DataFrame:
    """Drop rows where any of the columns has its value; missing values stay."""
    hits = [F.col(name).eqNullSafe(F.lit(value)) for name, value in values.items()]
    return df.where(~reduce(Column.__or__, hits))


def drop_listed(df: DataFrame, ref: Column | str, values: Sequence[str]) -> DataFrame:
    """Drop rows whose trimmed value is listed, and rows without a value."""
    return df.where(~F.trim(column(ref)).isin(list(values)))


def missing_rows(df: DataFrame, ref: Column | str) -> DataFrame:
    """Rows where a measure is missing."""
    return df.where(column(ref).isNull())
