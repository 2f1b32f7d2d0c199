"""Labels from breakpoints kept as rows, against a plain search and against labels written as code."""

from __future__ import annotations

import bisect
import random
from datetime import date, timedelta

from pyspark.sql import functions as F

from caseload.functions.labels import effective_dated_label
from caseload.operators.as_of import label_as_of

START = date(2000, 1, 1)


def test_ten_thousand_breakpoints(spark):
    rng = random.Random(3)
    steps = [(rng.choice("abc"), START + timedelta(rng.randrange(9000)), f"L{i:05}") for i in range(10_000)]
    rows = [
        (i, rng.choice(["a", "b", "c", "d", None]), None if i % 50 == 0 else START + timedelta(rng.randrange(-50, 9100)))
        for i in range(3000)
    ]
    # A third of the rows is one key on one day.
    rows += [(10_000 + i, "a", START + timedelta(4000)) for i in range(1500)]
    labels = spark.createDataFrame(steps, "g STRING, effective_from DATE, label STRING")
    found = label_as_of(spark.createDataFrame(rows, "id INT, g STRING, day DATE"), "day", labels, ["g"], base="none")
    by_day = {}
    for g, day, label in steps:
        by_day.setdefault(g, {})[day] = max(label, by_day.get(g, {}).get(day, ""))
    days = {g: sorted(d) for g, d in by_day.items()}

    def plain(g, day):
        if day is None or g not in days:
            return "none"
        at = bisect.bisect_right(days[g], day)
        return by_day[g][days[g][at - 1]] if at else "none"

    assert {tuple(r) for r in found.collect()} == {(i, g, day, plain(g, day)) for i, g, day in rows}


def test_one_list_for_all_rows(spark):
    df = spark.createDataFrame([(date(2020, m, 1),) for m in range(1, 6)], "day DATE")
    steps = spark.createDataFrame([(None, "first"), (date(2020, 3, 1), "later")], "effective_from DATE, label STRING")
    assert [r.label for r in label_as_of(df, "day", steps).orderBy("day").collect()] == ["first"] * 2 + ["later"] * 3
    assert [r.label for r in label_as_of(df, "day", steps.limit(0), base="b").collect()] == ["b"] * 5


def test_own_lists_and_the_default_one_equal_labels_as_code(spark):
    groups = ["own", "never", "other", "another", None]
    df = spark.createDataFrame(
        [(g, date(2025, m, 1), m) for g in groups for m in range(1, 13)], "g STRING, day DATE, label STRING"
    ).withColumnRenamed("label", "value")
    as_code = effective_dated_label(
        "day", "base", [("2025-08-01", "daily")], group="g",
        overrides={"never": [], "own": [("2025-03-01", "early"), ("2025-09-01", "daily")]},
    )
    own = spark.createDataFrame(
        [("own", date(2025, 3, 1), "early"), ("own", date(2025, 9, 1), "daily"), ("never", None, "base")],
        "g STRING, effective_from DATE, label STRING",
    )
    rest = spark.createDataFrame([(date(2025, 8, 1), "daily")], "effective_from DATE, label STRING")
    found = label_as_of(df, "day", own, ["g"], base="base", defaults=rest, name="method")
    expected = df.withColumn("method", F.coalesce(as_code, F.lit("base")))
    assert sorted(map(str, found.collect())) == sorted(map(str, expected.collect()))


def test_a_frequent_day_is_one_row_of_the_window(spark):
    df = spark.range(100_000).select(F.lit("a").alias("g"), F.lit(date(2024, 1, 1)).alias("day"))
    steps = spark.createDataFrame([("a", date(2023, 1, 1), "x")], "g STRING, effective_from DATE, label STRING")
    found = label_as_of(df, "day", steps, ["g"])
    assert found.where("label = 'x'").count() == 100_000
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    window = plan[plan.index("Window") :]
    assert "Aggregate" in window
