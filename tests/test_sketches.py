"""Distinct counts of spans from kept sketches, and frequent values from bounded summaries."""

from __future__ import annotations

from pyspark.sql import functions as F

from caseload.operators.sketches import distinct_over, distinct_sketches, frequent_values
from caseload.session import shared_folder

LINES = "/root/testdata/sf0.01/lineitem.parquet"


def test_three_spans_within_two_per_cent_without_the_detail(spark):
    lines = spark.read.parquet(LINES).withColumn("month", F.trunc("l_shipdate", "month"))
    folder = shared_folder(spark)
    distinct_sketches(lines, "l_orderkey", ["month"]).write.parquet(folder)
    kept = spark.read.parquet(folder)
    for span in ("month < '2100-01-01'", "month >= '1996-01-01' and month < '1997-01-01'", "month = '1997-03-01'"):
        exact = lines.where(span).agg(F.count_distinct("l_orderkey").alias("n"), F.count("*").alias("rows")).first()
        found = distinct_over(kept.where(span))
        row = found.first()
        assert row.n_rows == exact.rows > 0 and abs(row.n_distinct - exact.n) <= 0.02 * exact.n
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "lineitem" not in plan
    by_year = distinct_over(kept.withColumn("year", F.year("month")), ["year"])
    exact = dict(lines.groupBy(F.year("l_shipdate")).agg(F.count_distinct("l_orderkey")).collect())
    assert all(abs(r.n_distinct - exact[r.year]) <= 0.02 * exact[r.year] for r in by_year.collect())


def test_distinct_counts_of_nothing(spark):
    df = spark.createDataFrame([(1, None), (1, "a"), (1, "a"), (2, None)], "p INT, v STRING")
    kept = distinct_sketches(df, "v", ["p"])
    assert {(r.p, r.n_rows, r.n_distinct) for r in distinct_over(kept, ["p"]).collect()} == {(1, 3, 1), (2, 1, 0)}
    assert tuple(distinct_over(kept.limit(0)).first()) == (0, 0)


def skewed(spark):
    """Values from 0 on, each a little rarer than the one before, and a long tail of single ones."""
    heavy = spark.range(60).select(F.explode(F.array_repeat("id", (F.lit(3000) - F.col("id") * 50).cast("int"))).alias("v"))
    tail = spark.range(200_000).select((F.col("id") + 1000).alias("v"))
    return heavy.union(tail).union(spark.range(500).select(F.lit(None).cast("bigint"))).repartition(7)


def test_all_frequent_values_are_found_and_counted(spark):
    df = skewed(spark)
    total = df.count()
    for share in (0.001, 0.004):
        exact = {r.v: r["count"] for r in df.groupBy("v").count().where("v is not null").collect()}
        expected = {v: n for v, n in exact.items() if n > share * total}
        found = {r.value: r for r in frequent_values(df, "v", share).collect()}
        assert {v: r.n_rows for v, r in found.items()} == expected and expected
        assert all(abs(r.estimate - r.n_rows) <= r.max_error < share * total for r in found.values())


def test_texts_and_empty_frames(spark):
    df = spark.createDataFrame([("a",)] * 5 + [("b",)] * 3 + [(None,)] * 4, "v STRING")
    assert {(r.value, r.n_rows) for r in frequent_values(df, "v", 0.3).collect()} == {("a", 5)}
    assert frequent_values(df.limit(0), "v", 0.3).count() == 0
    assert frequent_values(df.where("v is null"), "v", 0.3).count() == 0
