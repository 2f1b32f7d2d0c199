"""Declared data checks, run as one aggregation per dataset and reported as rows.

A report has the columns (dataset, check, column, n_rows, n_failed, passed). All checks of a dataset
share a single read of it.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

REPORT = ["dataset", "check", "column", "n_rows", "n_failed", "passed"]


@dataclass(frozen=True)
class RowCheck:
    """Fails on the rows where `failing` holds (not where it is NULL)."""

    check: str
    column: str
    failing: Column


@dataclass(frozen=True)
class UniqueCheck:
    """Fails on each key that occurs more than once; keys with a missing part are ignored."""

    columns: tuple[str, ...]


@dataclass(frozen=True)
class RelationCheck:
    """Fails on the rows whose key has no match in the parent; missing keys are ignored."""

    columns: tuple[str, ...]
    parent: DataFrame
    parent_columns: tuple[str, ...]


@dataclass(frozen=True)
class ShareCheck:
    """Fails on the groups whose shares do not sum to one; groups without shares are ignored."""

    column: str
    keys: tuple[str, ...]
    tolerance: float = 1e-9


@dataclass(frozen=True)
class SingleValueCheck:
    """Fails by the number of values beyond the first; missing values are ignored."""

    column: str


@dataclass(frozen=True)
class RowCountCheck:
    """Fails by the number of rows missing or in excess."""

    expected: int


Check = RowCheck | UniqueCheck | RelationCheck | ShareCheck | SingleValueCheck | RowCountCheck


def not_null(column: str, where: Column | None = None) -> RowCheck:
    missing = F.col(column).isNull()
    if where is None:
        return RowCheck("not_null", column, missing)
    return RowCheck("not_null_where", column, where & missing)


def accepted_values(column: str, values: Sequence) -> RowCheck:
    return RowCheck("accepted_values", column, ~F.col(column).isin(list(values)))


def in_range(column: str, low: float, high: float) -> RowCheck:
    return RowCheck("in_range", column, ~F.col(column).between(low, high))


def unique(*columns: str) -> UniqueCheck:
    return UniqueCheck(columns)


def relationship(
    columns: str | Sequence[str], parent: DataFrame, parent_columns: str | Sequence[str]
) -> RelationCheck:
    return RelationCheck(_names(columns), parent, _names(parent_columns))


def shares_sum_to_one(column: str, *keys: str, tolerance: float = 1e-9) -> ShareCheck:
    return ShareCheck(column, keys, tolerance)


def single_value(column: str) -> SingleValueCheck:
    return SingleValueCheck(column)


def row_count(expected: int) -> RowCountCheck:
    return RowCountCheck(expected)


def run_checks(df: DataFrame, dataset: str, checks: Sequence[Check]) -> DataFrame:
    """The report of one dataset, from one read of it.

    Rows are first counted by each key that a check asks for (grouping sets, with map-side
    combine), together with the failures of all checks that look at one row at a time. A frequent
    key is one row by the time it is joined to a parent or counted as a duplicate.
    """
    keys = list(dict.fromkeys(k for c in checks if (k := _keys(c))))
    failures = {
        f"__f{i}": F.count_if(c.failing) for i, c in enumerate(checks) if isinstance(c, RowCheck)
    }
    shares = {
        f"__f{i}": F.sum(c.column) for i, c in enumerate(checks) if isinstance(c, ShareCheck)
    }
    sums = [F.count(F.lit(1)).alias("__n")]
    sums += [e.alias(name) for name, e in (failures | shares).items()]
    columns = list(dict.fromkeys(c for k in keys for c in k))
    if len(keys) > 1:
        sets = [[F.col(c) for c in key] for key in keys]
        grouped = df.groupingSets(sets, *columns).agg(*sums, F.grouping_id().alias("__set"))
    else:
        grouped = df.groupBy(*columns).agg(*sums).withColumn("__set", F.lit(0))
    # The set of a key, as Spark numbers it: a bit for each column that is not in it.
    number = {
        key: sum(1 << i for i, c in enumerate(reversed(columns)) if c not in key) for key in keys
    }
    first = F.col("__set") == (number[keys[0]] if keys else 0)
    lines = []
    for i, check in enumerate(checks):
        rows = F.col("__set") == number[key] if (key := _keys(check)) else first
        if isinstance(check, RelationCheck):
            grouped = _with_parent(grouped, check, rows, f"__f{i}")
        lines.append((check, rows, _failed(check, rows, f"__f{i}")))
    counted = grouped.agg(
        *[_total(rows, "__n").alias(f"n{i}") for i, (_, rows, _) in enumerate(lines)],
        *[failed.alias(f"f{i}") for i, (_, _, failed) in enumerate(lines)],
    )
    report = F.array(
        *[
            F.struct(
                F.lit(dataset).alias("dataset"),
                *_label(check),
                F.col(f"n{i}").alias("n_rows"),
                F.col(f"f{i}").alias("n_failed"),
                (F.col(f"f{i}") == 0).alias("passed"),
            )
            for i, (check, _, _) in enumerate(lines)
        ]
    )
    return counted.select(F.inline(report)).select(*REPORT)


def run_all(datasets: Mapping[str, tuple[DataFrame, Sequence[Check]]]) -> DataFrame:
    """The report of several datasets."""
    reports = [run_checks(df, name, checks) for name, (df, checks) in datasets.items()]
    return reduce(DataFrame.unionByName, reports)


def offending_values(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    """The values outside the accepted list, with how often each occurs."""
    return df.where(~F.col(column).isin(list(values))).groupBy(column).count()


def _keys(check: Check) -> tuple[str, ...]:
    """The columns that a check counts by."""
    if isinstance(check, UniqueCheck | RelationCheck):
        return check.columns
    if isinstance(check, SingleValueCheck):
        return (check.column,)
    return check.keys if isinstance(check, ShareCheck) else ()


def _total(rows: Column, name: str) -> Column:
    return F.coalesce(F.sum(F.when(rows, F.col(name))), F.lit(0)).cast("bigint")


def _present(columns: Sequence[str]) -> Column:
    return reduce(Column.__and__, [F.col(c).isNotNull() for c in columns])


def _failed(check: Check, rows: Column, name: str) -> Column:
    """The number that a check reports as failed, over the counted groups."""
    if isinstance(check, RowCheck):
        return _total(rows, name)
    if isinstance(check, RowCountCheck):
        return F.abs(_total(rows, "__n") - check.expected)
    if isinstance(check, UniqueCheck):
        return F.count_if(rows & _present(check.columns) & (F.col("__n") > 1))
    if isinstance(check, SingleValueCheck):
        return F.greatest(F.count_if(rows & _present([check.column])) - 1, F.lit(0))
    if isinstance(check, RelationCheck):
        return _total(rows & _present(check.columns) & F.col(name).isNull(), "__n")
    return F.count_if(rows & (F.abs(F.col(name) - 1) > check.tolerance))


def _with_parent(grouped: DataFrame, check: RelationCheck, rows: Column, name: str) -> DataFrame:
    """Mark the groups whose key is in the parent.

    Groups of other keys have no key here. They are joined by a hash of their own, which spreads
    them over the tasks.
    """
    aliases = [f"{name}_{i}" for i in range(len(check.columns))]
    parent = check.parent.select(*check.parent_columns).distinct().toDF(*aliases)
    parent = parent.withColumns({f"{name}_hash": F.xxhash64(*aliases), name: F.lit(True)})
    own = F.when(rows, F.xxhash64(*check.columns)).otherwise(
        F.xxhash64(F.lit("other"), *[c for c in grouped.columns if not c.startswith("__f")])
    )
    same = own == F.col(f"{name}_hash")
    for column, alias in zip(check.columns, aliases):
        same = same & (F.col(column) == F.col(alias))
    return grouped.join(parent, same, "left").drop(*aliases, f"{name}_hash")


def _label(check: Check) -> list[Column]:
    if isinstance(check, RowCheck):
        kind, columns = check.check, [check.column]
    elif isinstance(check, RowCountCheck):
        kind, columns = "row_count", []
    elif isinstance(check, ShareCheck):
        kind, columns = "shares_sum_to_one", [check.column]
    elif isinstance(check, SingleValueCheck):
        kind, columns = "single_value", [check.column]
    else:
        kind = "unique" if isinstance(check, UniqueCheck) else "relationship"
        columns = check.columns
    return [F.lit(kind).alias("check"), F.lit(", ".join(columns)).alias("column")]


def _names(columns: str | Sequence[str]) -> tuple[str, ...]:
    return (columns,) if isinstance(columns, str) else tuple(columns)
