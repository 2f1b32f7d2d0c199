"""Period-over-period, share, rolling and reconciliation metrics.

A *series* is a frame with one row per entity (`by` columns) and period, as a `groupBy` on
those columns makes it. Its windows are then no longer than the calendar, however large the
data behind it. A frame of one series has no entities; `single_series` says that it is grouped.
For rows that are not grouped, pass `piece`: a column that grows with the period, so that each
window holds one piece and not a whole series. `cut_evenly` makes one that no busy entity, hour
or moment can fill.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from ..functions.scalars import column, ratio


def series_window(period: str | Sequence[str], by: Sequence[str] = ()) -> WindowSpec:
    order = [period] if isinstance(period, str) else list(period)
    return Window.partitionBy(*by).orderBy(*order) if by else Window.orderBy(*order)


def _number_below(bounds: str, name: str, most: int) -> Column:
    """How many of the rising `bounds`, at most `most`, lie below a column: halved steps, not a look at each."""
    steps = [1 << i for i in reversed(range(most.bit_length()))]

    def step(found: Column, size: Column) -> Column:
        return F.when(F.get(bounds, found + size - 1) < F.col(name), found + size).otherwise(found)

    return F.aggregate(F.array(*map(F.lit, steps)), F.lit(0), step)


def cut_evenly(
    df: DataFrame, period: Sequence[str], name: str = "piece", pieces: int | None = None
) -> DataFrame:
    """Add the place of each row in the period order, in steps that hold about as many rows each.

    The steps are approximate percentiles of the period's columns (by default one per shuffle
    partition), computed by a subquery of the query that uses them: the place is a function of
    the row alone. A first column equal to a percentile may be a busy moment, so such rows are
    cut further by the next columns.
    """
    n = pieces or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    shares = [i / n for i in range(1, n)] or [0.5]
    bounds = {f"__bounds{i}": (c, F.percentile_approx(c, shares, 100 * n)) for i, c in enumerate(period)}
    held = df.withColumns({b: df.agg(percentiles).scalar() for b, (_, percentiles) in bounds.items()})
    first, *rest = bounds
    held = held.withColumn("__below", _number_below(first, period[0], len(shares)))
    equal = F.coalesce(F.get(first, F.col("__below")) == F.col(period[0]), F.lit(False))
    ties = [
        F.when(equal, _number_below(b, bounds[b][0], len(shares))).otherwise(0).alias(f"tie{b}") for b in rest
    ]
    place = F.struct(F.col("__below").alias("below"), equal.alias("equal"), *ties)
    return held.withColumn(name, place).drop(*bounds, "__below")


def prior_values(
    df: DataFrame,
    value: str,
    names: Sequence[str],
    period: str | Sequence[str],
    by: Sequence[str] = (),
    piece: Column | None = None,
    single_series: bool = False,
) -> DataFrame:
    """Add the values of the rows before, nearest first, one column per name.

    Rows are taken in period order within the same entity. It is the row before, not the
    calendar period before: a gap is stepped over.
    """
    _require_bounded(by, piece, single_series)
    steps = range(1, len(names) + 1)
    if piece is None:
        window = series_window(period, by)
        lags = [F.lag(value, step).over(window).alias(n) for step, n in zip(steps, names)]
        return df.select("*", *lags)

    # Within a piece `lag` finds the rows before. Where it would leave the piece, it takes
    # the last rows of the pieces before. The key is a struct, so that missing entity keys
    # meet each other as they do in a window.
    keyed = df.withColumn("__piece", F.struct(*by, piece.alias("__at")))
    inside = series_window(period, ["__piece"])
    marked = keyed.select(
        "*",
        F.row_number().over(inside).alias("__row"),
        *[F.lag(value, step).over(inside).alias(f"__lag{step}") for step in steps],
    )
    carried = _rows_before_piece(keyed, value, len(names), period, bool(by))
    found = [
        F.when(F.col("__row") > step, F.col(f"__lag{step}"))
        .otherwise(F.get("__before", F.size("__before") - step + F.col("__row") - 1))
        .alias(name)
        for step, name in zip(steps, names)
    ]
    return marked.join(carried, "__piece", "left").select(*df.columns, *found)


def _require_bounded(by: Sequence[str], piece: Column | None, single_series: bool) -> None:
    if not by and piece is None and not single_series:
        raise ValueError(
            "one window would hold all rows: pass by or piece, or single_series=True for a frame "
            "that is grouped to one row per period"
        )


def _rows_before_piece(
    keyed: DataFrame, value: str, rows: int, period: str | Sequence[str], by_entity: bool
) -> DataFrame:
    """Per piece, the last `rows` values of the pieces before it, oldest first.

    Only the last rows of each piece are shuffled: Spark applies the limit on the row number
    before the exchange. What is collected per piece has at most `rows` entries per piece
    looked back on, and the pieces of an entity are bounded by the calendar.
    """
    order = [period] if isinstance(period, str) else list(period)
    backwards = Window.partitionBy("__piece").orderBy(*[F.desc(c) for c in order])
    last = keyed.select(
        "__piece", F.col(value).alias("v"), F.row_number().over(backwards).alias("__n")
    )
    ends = (
        last.where(F.col("__n") <= rows)
        .groupBy("__piece")
        .agg(F.sort_array(F.collect_list(F.struct((-F.col("__n")).alias("n"), "v"))).alias("__end"))
        .withColumn("__at", F.col("__piece")["__at"])
        .withColumn("__entity", F.col("__piece").dropFields("__at") if by_entity else F.lit(0))
    )
    # Every piece has a row, so as many pieces as rows wanted always hold enough of them.
    earlier = series_window("__at", ["__entity"]).rowsBetween(-rows, -1)
    before = F.flatten(F.collect_list("__end").over(earlier))
    return ends.withColumn("__before", before).select(
        "__piece", F.transform("__before", lambda end: end["v"]).alias("__before")
    )


def change_columns(
    value: str, prior: str, change: str = "mom_change", pct: str | None = "mom_change_pct"
) -> list[Column]:
    """The change against a prior value, and the same as a fraction of it.

    Both are NULL without a prior value; against a zero the fraction is 0.
    """
    difference = F.col(value) - F.col(prior)
    columns = [difference.alias(change)]
    return columns + ([ratio(difference, prior).alias(pct)] if pct else [])


def mean_of_present(columns: Sequence[str]) -> Column:
    """Mean over the columns that have a value, added up in the order given."""
    values = [F.col(c).cast("double") for c in columns]
    total = reduce(Column.__add__, [F.coalesce(v, F.lit(0.0)) for v in values])
    present = reduce(Column.__add__, [v.isNotNull().cast("int") for v in values])
    return ratio(total, present, on_zero="null")


def period_change(
    df: DataFrame,
    value: str,
    period: str | Sequence[str],
    by: Sequence[str] = (),
    *,
    change: str = "mom_change",
    pct: str | None = "mom_change_pct",
    piece: Column | None = None,
    single_series: bool = False,
) -> DataFrame:
    """Add the change against the row before, see `change_columns`."""
    lagged = prior_values(df, value, ["__prior"], period, by, piece, single_series)
    return lagged.select(*df.columns, *change_columns(value, "__prior", change, pct))


def rolling_mean(
    df: DataFrame,
    value: str,
    name: str,
    period: str | Sequence[str],
    by: Sequence[str] = (),
    *,
    rows: int = 3,
    piece: Column | None = None,
    single_series: bool = False,
) -> DataFrame:
    """Add the mean over this row and the `rows - 1` before it, missing values left out."""
    _require_bounded(by, piece, single_series)
    if piece is None:
        frame = series_window(period, by).rowsBetween(1 - rows, 0)
        return df.withColumn(name, F.avg(value).over(frame))
    before = [f"__back{step}" for step in range(1, rows)]
    held = prior_values(df, value, before, period, by, piece)
    return held.select(*df.columns, mean_of_present([*reversed(before), value]).alias(name))


def share_of(
    df: DataFrame,
    value: str,
    shares: Mapping[str, Sequence[str]],
    *,
    component: Column | None = None,
    component_shares: Sequence[str] | None = None,
    mask_outside: bool = False,
) -> DataFrame:
    """Add shares of group totals: `shares` maps each new column to the keys of its total.

    With `component`, totals sum only the rows where it holds (so that overlapping groups
    are not counted twice), for all shares or those in `component_shares`; every row still
    gets a share, unless `mask_outside`. A group without such rows, or a row with a missing
    key, gets NULL.

    The totals are joined null-safe and sum a conditional value instead of filtering: both
    keep Catalyst from pushing a filter of their own below them, so that `df` and its totals
    read one and the same aggregate and Spark runs that only once. Totals over some of another
    share's keys are summed from that share's totals, and join the rows together with them. No
    side is hinted: adaptive execution broadcasts totals that turn out small, and splits skewed
    groups where they are not.
    """
    def measure_of(name: str) -> Column:
        limited = component is not None and (component_shares is None or name in component_shares)
        return F.when(component, F.col(value)) if limited else F.col(value)

    def share(name: str) -> Column:
        present = [F.col(key).isNotNull() for key in shares[name]]
        limited = component is not None and (component_shares is None or name in component_shares)
        if limited and mask_outside:
            present.append(component)
        return F.when(reduce(Column.__and__, present), ratio(value, f"__total_{name}")).alias(name)

    out, todo = df, list(shares)
    while todo:
        widest = max(todo, key=lambda name: len(shares[name]))
        nested = [n for n in todo if set(shares[n]) <= set(shares[widest])]
        todo = [n for n in todo if n not in nested]
        keys = list(shares[widest])
        as_key = {key: f"__key{i}" for i, key in enumerate(keys)}
        fine = df.groupBy(*keys).agg(*[F.sum(measure_of(n)).alias(f"__total_{n}") for n in nested])
        totals = fine
        for n in nested:
            if set(shares[n]) != set(keys):
                totals = _with_coarser(totals, fine, f"__total_{n}", shares[n])
        totals = totals.withColumnsRenamed(as_key)
        same = [F.col(key).eqNullSafe(F.col(alias)) for key, alias in as_key.items()]
        out = out.join(totals, reduce(Column.__and__, same), "left").drop(*as_key.values())
    return out.select(*df.columns, *map(share, shares))


def _with_coarser(totals: DataFrame, fine: DataFrame, total: str, keys: Sequence[str]) -> DataFrame:
    """`totals` with a total summed over some of their keys: grouped with map-side combine, and joined
    back, so that a key that most rows share is one row, and no task's work."""
    as_key = {key: f"__coarse{i}" for i, key in enumerate(keys)}
    coarse = fine.groupBy(*keys).agg(F.sum(total).alias("__coarse")).withColumnsRenamed(as_key)
    same = [F.col(key).eqNullSafe(F.col(alias)) for key, alias in as_key.items()]
    joined = totals.join(coarse, reduce(Column.__and__, same), "left")
    return joined.withColumn(total, F.col("__coarse")).drop(*as_key.values(), "__coarse")


def variance_vs_reported(computed: Column | str, reported: Column | str) -> Column:
    """How far a recomputed figure lies from the published one."""
    return column(computed) - column(reported)


def stock_flow_variance(
    df: DataFrame,
    stock: str,
    inflow: str,
    outflow: str,
    period: str | Sequence[str],
    by: Sequence[str] = (),
    *,
    name: str = "caseload_reconciliation_variance_pct",
    piece: Column | None = None,
    single_series: bool = False,
) -> DataFrame:
    """Add the part of a stock that the stock before and the flows do not explain."""
    lagged = prior_values(df, stock, ["__prior"], period, by, piece, single_series)
    implied = F.col("__prior") + F.col(inflow) - F.col(outflow)
    return lagged.withColumn(name, ratio(F.col(stock) - implied, stock)).drop("__prior")
