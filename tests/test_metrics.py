from __future__ import annotations

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from caseload.operators.metrics import (
    cut_evenly,
    period_change,
    prior_values,
    rolling_mean,
    share_of,
    stock_flow_variance,
)

SERIES = "g STRING, t INT, v DOUBLE"


def frame(spark, rows, schema=SERIES):
    return spark.createDataFrame(rows, schema)


def by_key(df, *keys):
    return {tuple(r[k] for k in keys): r for r in df.collect()}


def test_change_first_row_zero_prior_gap_and_null(spark):
    rows = [("a", 1, 0.0), ("a", 2, 5.0), ("a", 5, 10.0), ("a", 6, None), ("a", 7, 4.0), ("b", 2, 7.0)]
    out = by_key(period_change(frame(spark, rows), "v", "t", ["g"]), "g", "t")
    got = {k: (r.mom_change, r.mom_change_pct) for k, r in out.items()}
    assert got == {
        ("a", 1): (None, None),
        ("a", 2): (5.0, 0.0),
        ("a", 5): (5.0, 1.0),
        ("a", 6): (None, None),
        ("a", 7): (None, None),
        ("b", 2): (None, None),
    }


def test_changes_of_a_series_sum_to_last_less_first(spark):
    rows = [("a", t, float(t * t % 17)) for t in range(30)]
    out = period_change(frame(spark, rows), "v", "t", ["g"])
    assert out.agg(F.sum("mom_change")).first()[0] == rows[-1][2] - rows[0][2]


def test_change_without_entities(spark):
    out = period_change(frame(spark, [("a", 1, 2.0), ("b", 2, 3.0)]), "v", "t", pct=None, single_series=True)
    assert out.columns == ["g", "t", "v", "mom_change"]
    assert by_key(out, "t")[(2,)].mom_change == 1.0


def random_rows(seed):
    rng = random.Random(seed)
    rows = []
    for group in ["hot", "b", None]:
        size = 400 if group == "hot" else rng.randint(0, 40)
        for t in rng.sample(range(1000), size):
            rows.append((group, t, rng.choice([None, 0.0, round(rng.uniform(-9, 9), 2)])))
    return rows


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("width", [1, 7, 100, 5000])
def test_pieces_give_what_whole_series_give(spark, seed, width):
    rows = random_rows(seed)
    df = frame(spark, rows)
    piece = F.floor(F.col("t") / width)
    back = ["b1", "b2", "b3"]
    pieced = by_key(prior_values(df, "v", back, "t", ["g"], piece=piece), "g", "t")
    series = defaultdict(list)
    for group, t, value in sorted(rows, key=lambda r: r[1]):
        before = [v for _, v in series[group][::-1][:3]]
        expected = tuple(before + [None] * (3 - len(before)))
        series[group].append((t, value))
        got = pieced[(group, t)]
        assert (got.b1, got.b2, got.b3) == expected
    assert len(pieced) == len(rows)


def test_pieces_without_entities(spark):
    df = frame(spark, [("a", t, float(t)) for t in range(50)])
    out = prior_values(df, "v", ["b1", "b2"], "t", piece=F.floor(F.col("t") / 4))
    for r in out.collect():
        assert (r.b1, r.b2) == (r.t - 1.0 if r.t > 0 else None, r.t - 2.0 if r.t > 1 else None)


def test_even_pieces_split_a_busy_entity_and_moment(spark):
    rows = [("hot", 7, float(i)) for i in range(2000)] + [("b", i, float(i)) for i in range(50)]
    cut = cut_evenly(frame(spark, rows), ["t", "v"], pieces=8)
    sizes = [r["count"] for r in cut.groupBy("piece").count().collect()]
    assert max(sizes) < 2 * len(rows) / 8
    out = prior_values(cut, "v", ["b"], ["t", "v"], ["g"], piece=F.col("piece"))
    got = {(r.g, r.v): r.b for r in out.collect()}
    assert got == {(g, v): v - 1 if v else None for g, _, v in rows}


def test_pieces_of_value_named_like_the_order(spark):
    df = frame(spark, [("a", t, 0.0) for t in range(9)])
    out = prior_values(df, "t", ["b"], ["t", "v"], ["g"], piece=F.floor(F.col("t") / 2))
    assert {r.t: r.b for r in out.collect()} == {t: t - 1 if t else None for t in range(9)}


@pytest.mark.parametrize("piece", [None, F.lit])
def test_rolling_mean_short_start_and_nulls(spark, piece):
    rows = [("a", 1, 1.0), ("a", 2, 2.0), ("a", 3, None), ("a", 4, 6.0), ("b", 1, None)]
    cut = None if piece is None else F.floor(F.col("t") / 2)
    out = by_key(rolling_mean(frame(spark, rows), "v", "m", "t", ["g"], piece=cut), "g", "t")
    got = {k: r.m for k, r in out.items()}
    assert got == {("a", 1): 1.0, ("a", 2): 1.5, ("a", 3): 1.5, ("a", 4): 4.0, ("b", 1): None}


def test_rolling_mean_is_a_mean_of_ratios(spark):
    rows = [("a", 1, 0.5), ("a", 2, 1.0), ("a", 3, 0.0), ("a", 4, 0.25)]
    out = by_key(rolling_mean(frame(spark, rows), "v", "m", "t", ["g"]), "t")
    assert out[(3,)].m == 0.5
    assert out[(4,)].m == pytest.approx(1.25 / 3)


SHARES = "m STRING, g STRING, kind STRING, v DOUBLE"
SHARE_ROWS = [
    ("jan", "a", "part", 1.0),
    ("jan", "b", "part", 3.0),
    ("jan", "young", "age", 2.0),
    ("feb", "young", "age", 5.0),
    ("mar", "a", "part", 0.0),
    (None, "a", "part", 1.0),
]


def test_share_of_component_total_for_all_rows(spark):
    out = share_of(
        frame(spark, SHARE_ROWS, SHARES), "v", {"s": ["m"]}, component=F.col("kind") == "part"
    )
    assert {(r.m, r.g): r.s for r in out.collect()} == {
        ("jan", "a"): 0.25,
        ("jan", "b"): 0.75,
        ("jan", "young"): 0.5,
        ("feb", "young"): None,
        ("mar", "a"): 0.0,
        (None, "a"): None,
    }


def test_share_masked_outside_the_component(spark):
    out = share_of(
        frame(spark, SHARE_ROWS, SHARES),
        "v",
        {"s": ["m"]},
        component=F.col("kind") == "part",
        mask_outside=True,
    )
    assert {(r.m, r.g): r.s for r in out.collect()}[("jan", "young")] is None


def test_two_shares_of_which_one_is_of_the_component(spark):
    out = share_of(
        frame(spark, SHARE_ROWS, SHARES),
        "v",
        {"of_month": ["m"], "of_group": ["g", "kind"]},
        component=F.col("kind") == "part",
        component_shares=["of_month"],
    )
    got = {(r.m, r.g): (r.of_month, r.of_group) for r in out.collect()}
    assert got[("jan", "young")] == (0.5, 2 / 7)
    assert got[("jan", "a")] == (0.25, 0.5)
    assert len(got) == len(SHARE_ROWS)


def test_shares_sum_to_one_with_a_hot_group(spark):
    rows = [("jan" if i % 3 else f"m{i}", str(i), "part", float(i + 1)) for i in range(600)]
    out = share_of(frame(spark, rows, SHARES), "v", {"s": ["m"]})
    sums = out.groupBy("m").agg(F.sum("s").alias("s")).collect()
    assert all(r.s == pytest.approx(1) for r in sums)


STOCK = "t INT, stock DOUBLE, i DOUBLE, o DOUBLE"


def test_exact_flows_leave_no_variance(spark):
    stock, rows = 100.0, [(0, 100.0, 5.0, 5.0)]
    for t in range(1, 20):
        stock += t - 2.0
        rows.append((t, stock, float(t), 2.0))
    out = stock_flow_variance(frame(spark, rows, STOCK), "stock", "i", "o", "t", name="x", single_series=True)
    assert {r.t: r.x for r in out.collect()} == {0: None, **{t: 0.0 for t in range(1, 20)}}


def test_variance_of_inexact_flows(spark):
    rows = [(0, 100.0, 0.0, 0.0), (1, 80.0, 10.0, 20.0), (2, 0.0, 1.0, 1.0)]
    out = stock_flow_variance(frame(spark, rows, STOCK), "stock", "i", "o", "t", name="x", single_series=True)
    assert {r.t: r.x for r in out.collect()} == {0: None, 1: (80 - 90) / 80, 2: 0.0}


def test_a_window_over_all_rows_must_be_asked_for(spark):
    df = frame(spark, [("a", 1, 2.0)])
    for run in (lambda: period_change(df, "v", "t"), lambda: rolling_mean(df, "v", "m", "t")):
        with pytest.raises(ValueError, match="single_series"):
            run()


def test_shares_of_nested_totals_join_the_rows_once(spark):
    rows = [("a", 1, 1.0), ("a", 2, 3.0), ("b", 1, 4.0), (None, 1, 2.0)]
    out = share_of(frame(spark, rows), "v", {"fine": ["g", "t"], "coarse": ["t"]})
    assert {(r.g, r.t): (r.fine, r.coarse) for r in out.collect()} == {
        ("a", 1): (1.0, 1 / 7), ("a", 2): (1.0, 1.0), ("b", 1): (1.0, 4 / 7), (None, 1): (None, 2 / 7),
    }
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    # The rows are joined once; the coarse totals join the fine ones, and no window holds a coarse key.
    assert plan.count("Join ") == 2 and "Window" not in plan


def test_bounds_below_a_value_by_halved_steps(spark):
    from caseload.operators.metrics import _number_below

    for bounds in ([], [5], [1, 1, 2, 5, 5, 9], list(range(0, 400, 3))):
        df = frame(spark, [("a", x, 0.0) for x in (-1, 0, 1, 2, 5, 6, 9, 10, 399, 500)] + [("a", None, 0.0)])
        df = df.withColumn("bounds", F.lit(bounds) if bounds else F.array().cast("array<int>"))
        found = df.select("t", _number_below("bounds", "t", max(1, len(bounds))).alias("n")).collect()
        assert all(r.n == (0 if r.t is None else sum(b < r.t for b in bounds)) for r in found)
