from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from caseload.operators import profiling, quality


def results(report):
    return {(r.check, r.column): (r.n_rows, r.n_failed, r.passed) for r in report.collect()}


def test_row_checks_ignore_null_where_they_should(spark):
    df = spark.createDataFrame(
        [("a", 1.0, True), ("b", None, True), (None, 9.0, None), ("z", None, False)],
        "label STRING, x DOUBLE, flag BOOLEAN",
    )
    report = quality.run_checks(
        df,
        "d",
        [
            quality.not_null("x"),
            quality.not_null("x", where=F.col("flag")),
            quality.accepted_values("label", ["a", "b"]),
            quality.in_range("x", 0, 5),
            quality.row_count(6),
        ],
    )
    assert report.columns == quality.REPORT
    assert results(report) == {
        ("not_null", "x"): (4, 2, False),
        ("not_null_where", "x"): (4, 1, False),
        ("accepted_values", "label"): (4, 1, False),
        ("in_range", "x"): (4, 1, False),
        ("row_count", ""): (4, 2, False),
    }


def test_unique_counts_keys_and_ignores_missing(spark):
    df = spark.createDataFrame(
        [(1, "a"), (1, "a"), (1, "b"), (2, None), (2, None), (None, "a")], "k INT, g STRING"
    )
    report = quality.run_checks(df, "d", [quality.unique("k"), quality.unique("k", "g")])
    assert results(report) == {("unique", "k"): (6, 2, False), ("unique", "k, g"): (6, 1, False)}


def test_relationship_counts_orphan_rows(spark):
    child = spark.createDataFrame([(1,), (1,), (3,), (3,), (3,), (None,)], "k INT")
    parent = spark.createDataFrame([(1,), (1,), (2,), (None,)], "id INT")
    report = quality.run_checks(child, "d", [quality.relationship("k", parent, "id")])
    assert results(report) == {("relationship", "k"): (6, 3, False)}


def test_shares_sum_to_one(spark):
    df = spark.createDataFrame(
        [("a", 0.25), ("a", 0.75), ("b", 0.5), ("c", None), ("d", 1.0)], "k STRING, s DOUBLE"
    )
    report = quality.run_checks(df, "d", [quality.shares_sum_to_one("s", "k")])
    assert results(report) == {("shares_sum_to_one", "s"): (5, 1, False)}


def test_checks_of_every_kind_share_one_read(spark):
    df = spark.createDataFrame(
        [(1, "a", 0.5, 7), (1, "a", 0.5, 7), (2, "b", 1.0, 8), (None, "b", None, None)],
        "k INT, g STRING, s DOUBLE, y INT",
    )
    parent = spark.createDataFrame([(1,), (5,)], "k INT")
    checks = [
        quality.not_null("k"), quality.unique("k"), quality.unique("k", "g"),
        quality.relationship("k", parent, "k"), quality.shares_sum_to_one("s", "g"),
        quality.single_value("y"), quality.row_count(4), quality.relationship("g", df.limit(1), "g"),
    ]
    report = quality.run_checks(df, "d", checks).collect()
    assert [(r.check, r.column, r.n_rows, r.n_failed) for r in report] == [
        ("not_null", "k", 4, 1), ("unique", "k", 4, 1), ("unique", "k, g", 4, 1),
        ("relationship", "k", 4, 1), ("shares_sum_to_one", "s", 4, 0),
        ("single_value", "y", 4, 1), ("row_count", "", 4, 0), ("relationship", "g", 4, 2),
    ]


def test_checks_on_an_empty_dataset_pass(spark):
    df = spark.createDataFrame([], "k INT, s DOUBLE")
    checks = [
        quality.not_null("k"),
        quality.unique("k"),
        quality.relationship("k", df, "k"),
        quality.shares_sum_to_one("s", "k"),
    ]
    report = quality.run_all({"d": (df, checks)})
    assert [(r.n_rows, r.n_failed, r.passed) for r in report.collect()] == [(0, 0, True)] * 4


def test_offending_values(spark):
    df = spark.createDataFrame([("a",), ("x",), ("x",), (None,)], "v STRING")
    assert [tuple(r) for r in quality.offending_values(df, "v", ["a"]).collect()] == [("x", 2)]


def test_fractional_profile_finds_the_change_of_method(spark):
    rows = [(date(2025, m, 1), float(m) + (0.5 if m >= 8 else 0.0), m, None) for m in range(1, 13)]
    df = spark.createDataFrame(rows, "month DATE, switched DOUBLE, whole INT, empty DOUBLE")
    out = profiling.fractional_profile(df, "month")
    assert {tuple(r) for r in out.collect()} == {
        ("switched", True, date(2025, 8, 1)),
        ("whole", False, None),
        ("empty", False, None),
    }


def test_value_profiles(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), (None,), ("c",), ("c",)], "v STRING")
    assert [tuple(r) for r in profiling.value_counts(df, "v").collect()] == [("b", 2), ("c", 2), ("a", 1)]
    assert {tuple(r) for r in profiling.group_sizes(df, "v").collect()} == {
        ("a", 1), ("b", 2), ("c", 2), (None, 1),
    }
    assert [r.v for r in profiling.distinct_values(df, "v").collect()] == [None, "a", "b", "c"]
    assert profiling.distinct_count(df, "v").first().v == 3
    assert profiling.distinct_count(df, "v", approximate=True).first().v == 3


def test_last_and_first_rows(spark):
    df = spark.range(20).select(F.col("id").alias("t"))
    assert [r.t for r in profiling.last_rows(df, ["t"], 3).collect()] == [17, 18, 19]
    assert [r.t for r in profiling.first_rows(df, ["t"], 2).collect()] == [0, 1]


def test_ratio_by_period_and_schema(spark):
    df = spark.createDataFrame([(1, 1.0, 2.0), (2, 1.0, 0.0)], "t INT, a DOUBLE, b DOUBLE")
    out = profiling.ratio_by_period(df, "a", "b", "t")
    assert [r.ratio for r in out.orderBy("t").collect()] == [0.5, None]
    assert [tuple(r) for r in profiling.describe_schema(df).collect()] == [
        ("t", "int"), ("a", "double"), ("b", "double"),
    ]
