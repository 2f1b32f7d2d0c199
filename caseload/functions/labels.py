"""Labels and flags computed from a row's own columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from .scalars import column


def category_map(value: Column | str, categories: Mapping[str, Sequence[str]]) -> Column:
    """Label whose list holds the value; NULL when no list does."""
    value = column(value)
    arms = [(value.isin(list(members)), label) for label, members in categories.items()]
    first, *rest = arms
    return reduce(lambda case, arm: case.when(*arm), rest, F.when(*first))


def effective_dated_label(
    period: Column | str,
    base: str,
    switches: Sequence[tuple[str, str]],
    *,
    group: Column | str | None = None,
    overrides: Mapping[str, Sequence[tuple[str, str]]] | None = None,
) -> Column:
    """Label in force in a period.

    `switches` lists `(first day, label)` and holds for every group that `overrides` does
    not name; a group named there follows its own list, an empty one meaning it never
    leaves `base`. Rows before the first switch, or without a group, carry `base`.
    """
    period = column(period)

    def in_force(steps: Sequence[tuple[str, str]]) -> Column:
        label = F.lit(base)
        for first_day, name in sorted(steps):
            label = F.when(period >= F.lit(first_day).cast("date"), F.lit(name)).otherwise(label)
        return label

    if group is None:
        return in_force(switches)
    group, own = column(group), overrides or {}
    case = F.when(group.isNull(), F.lit(base))
    for name, steps in own.items():
        case = case.when(group == name, in_force(steps))
    return case.otherwise(in_force(switches))


def flag_in(value: Column | str, members: Sequence[str]) -> Column:
    """Membership flag on the value as it stands; a missing value is not a member."""
    return F.coalesce(column(value).isin(list(members)), F.lit(False))
