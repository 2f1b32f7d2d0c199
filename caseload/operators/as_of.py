"""Labels that change on given days, kept as rows of a table and not as code."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

FROM, LABEL = "effective_from", "label"


def label_as_of(
    df: DataFrame,
    period: str,
    labels: DataFrame,
    by: Sequence[str] = (),
    *,
    base: str | None = None,
    defaults: DataFrame | None = None,
    name: str = LABEL,
) -> DataFrame:
    """Add the label in force in each row's period: the one of the last breakpoint up to that day.

    `labels` has the columns `by`, `effective_from` (a day) and `label`; a row without a day holds from the
    start. Of several labels for one day the largest holds. Before the first, and without a key, rows carry
    `base`. `defaults` (effective_from, label) is the list for rows whose key has none of its own.

    Days and breakpoints of a key are sorted together and the last label is carried on. The window holds
    each day of a key once, however many rows have it, so it is no longer than the calendar; rows get their
    label by a join on key and day, which adaptive execution splits where one of them is frequent.
    """
    if defaults is None:
        found = _carried(df.select(*by, period).distinct(), period, labels, by)
        return _joined(df, found, [*by, period], base, name)
    own = labels.select(*by).distinct().withColumn("__own", F.lit(True))
    days = df.select(*by, period).distinct().join(own, list(by), "left")
    mine = _carried(days.where("__own").select(*by, period), period, labels, by)
    # The days of all other keys share one list.
    theirs = _carried(days.where("__own IS NULL").select(period).distinct(), period, defaults, ())
    others = days.where("__own IS NULL").select(*by, period).join(
        theirs.withColumnRenamed(period, "__day"), F.col(period).eqNullSafe(F.col("__day")), "left"
    )
    known = reduce(Column.__and__, [F.col(key).isNotNull() for key in by])
    others = others.select(*by, period, F.when(known, F.col("__label")).alias("__label"))
    return _joined(df, mine.unionByName(others), [*by, period], base, name)


def _carried(days: DataFrame, period: str, labels: DataFrame, by: Sequence[str]) -> DataFrame:
    """`days` with `__label`."""
    steps = labels.groupBy(*by, F.col(FROM).alias(period)).agg(F.max(LABEL).alias("__label"))
    steps = steps.withColumn("__asked", F.lit(False))
    asked = days.withColumns({"__label": F.lit(None).cast(labels.schema[LABEL].dataType), "__asked": F.lit(True)})
    # A breakpoint comes before the rows of its day.
    order = Window.partitionBy(*by).orderBy(F.asc_nulls_first(period), "__asked")
    carried = F.last("__label", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, 0))
    return steps.unionByName(asked).withColumn("__label", carried).where("__asked").drop("__asked")


def _joined(df: DataFrame, found: DataFrame, keys: Sequence[str], base: str | None, name: str) -> DataFrame:
    as_key = {key: f"__key{i}" for i, key in enumerate(keys)}
    same = [F.col(key).eqNullSafe(F.col(alias)) for key, alias in as_key.items()]
    joined = df.join(found.withColumnsRenamed(as_key), reduce(Column.__and__, same), "left")
    known = reduce(Column.__and__, [F.col(key).isNotNull() for key in keys])
    label = F.when(known, F.col("__label"))
    return joined.select(*df.columns, (label if base is None else F.coalesce(label, F.lit(base))).alias(name))
