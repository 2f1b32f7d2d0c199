from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F

from caseload.functions import labels, names, scalars
from caseload.functions.sql import register_sql_functions


@pytest.mark.parametrize(
    "top, bottom, zero, null",
    [
        (3.0, 4.0, 0.75, 0.75),
        (3.0, 0.0, 0.0, None),
        (0.0, 0.0, 0.0, None),
        (None, 4.0, None, None),
        (3.0, None, None, None),
        (None, 0.0, None, None),
    ],
)
def test_ratio_over_zero_and_null(one, top, bottom, zero, null):
    assert one(scalars.ratio("a", "b"), a=top, b=bottom) == zero
    assert one(scalars.ratio("a", "b", on_zero="null"), a=top, b=bottom) == null


def test_ratio_as_rounded_percentage(one):
    percent = scalars.ratio("a", "b", on_zero="null", scale=100, digits=2)
    assert one(percent, a=2, b=3) == 66.67


def test_ratio_rejects_unknown_rule():
    with pytest.raises(ValueError):
        scalars.ratio("a", "b", on_zero="one")


@pytest.mark.parametrize("zone", ["UTC", "America/Chicago", "Asia/Tokyo"])
@pytest.mark.parametrize(
    "micros, day",
    [
        (1756684800000000, date(2025, 9, 1)),
        (1756684799999999, date(2025, 8, 31)),
        (0, date(1970, 1, 1)),
        (-1, date(1969, 12, 31)),
    ],
)
def test_epoch_dates_in_any_zone(spark, one, zone, micros, day):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        assert one(scalars.epoch_micros_to_date("m"), m=micros) == day
        back = scalars.date_to_epoch_micros(F.lit(day.isoformat()).cast("date"))
        assert one(back) == micros - micros % 86_400_000_000
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


@pytest.mark.parametrize("value, rounded", [(2.5, 3), (3.5, 4), (-2.5, -3), (2.4, 2), (None, None)])
def test_integer_cast_rounds(one, value, rounded):
    assert one(scalars.round_to_long("v"), v=value) == rounded


@pytest.mark.parametrize(
    "text, number",
    [
        ("12", 12.0), (" 12 ", 12.0), ("\t-1.5\n", -1.5), ("1e3", 1000.0), (".5", 0.5),
        ("5.", 5.0), ("1d", None), ("NaN", None), ("Infinity", None), ("", None), ("TOTAL", None),
        ("1 2", None), ("1,000", None), (None, None),
    ],
)
def test_number_or_null(one, text, number):
    assert one(scalars.number_or_null(F.lit(text).cast("string"))) == number


def test_missing_to_null(one):
    assert one(scalars.missing_to_null("v"), v=float("nan")) is None
    assert one(scalars.missing_to_null("v"), v=1.5) == 1.5


def test_clean_text_strips_what_python_strips(one):
    text = " \x1f two\nlines\xa0\n \t"
    assert one(scalars.clean_text("t"), t=text) == text.replace("\n", " ").strip()
    assert one(scalars.strip("t"), t=text) == text.strip()


@pytest.mark.parametrize("value, fraction", [(1.5, True), (2.0, False), (-0.25, True), (None, False)])
def test_has_fraction(one, value, fraction):
    assert one(scalars.has_fraction("v"), v=value) is fraction


def test_category_map_leaves_others_null(one):
    categories = {"a": ["x", "y"], "b": ["z"]}
    for value, label in [("x", "a"), ("y", "a"), ("z", "b"), ("q", None)]:
        assert one(labels.category_map("v", categories), v=value) == label


@pytest.mark.parametrize(
    "group, day, label",
    [
        ("never", "2030-01-01", "old"),
        ("late", "2025-08-31", "old"),
        ("late", "2025-09-01", "new"),
        ("other", "2025-07-31", "old"),
        ("other", "2025-08-01", "new"),
        (None, "2030-01-01", "old"),
    ],
)
def test_label_follows_the_rule_of_its_group(one, group, day, label):
    expression = labels.effective_dated_label(
        F.lit(day).cast("date"),
        "old",
        [("2025-08-01", "new")],
        group=F.lit(group).cast("string"),
        overrides={"never": [], "late": [("2025-09-01", "new")]},
    )
    assert one(expression) == label


def test_label_with_several_switches(one):
    switches = [("2025-08-01", "second"), ("2024-01-01", "first")]
    for day, label in [("2023-12-31", "base"), ("2024-01-01", "first"), ("2026-01-01", "second")]:
        day = F.lit(day).cast("date")
        assert one(labels.effective_dated_label(day, "base", switches)) == label


def test_flag_in_is_false_for_missing_and_untrimmed(one):
    for value, flag in [("01", True), (" 01", False), ("99", False), (None, False)]:
        assert one(labels.flag_in(F.lit(value).cast("string"), ["01", "02/09"])) is flag


HEADERS = [
    (" Aged & Medicare-Related ", "aged_and_medicare_related"),
    ("Children’s Medicaid.1", "childrens_medicaid_1"),
    ("Children's Medicaid", "childrens_medicaid"),
    ("Parents *", "parents_"),
    ("Parents*", "parents"),
    ("Unnamed: 1", "unnamed:_1"),
]


@pytest.mark.parametrize("header, name", HEADERS)
def test_normalised_names(one, header, name):
    assert names.normalise_name(header) == name
    assert one(names.normalised(F.col("h")), h=header) == name


def test_basic_level_replaces_blanks_only(one):
    assert names.normalise_name(" Percent (A-B) ", "basic") == "percent_(a-b)"
    assert one(names.normalised(F.col("h"), "basic"), h=" Percent (A-B) ") == "percent_(a-b)"


def test_normalise_columns(spark):
    df = spark.range(1).select(F.lit(1).alias(" Fiscal Year "), F.lit(2).alias("A-B*"))
    assert names.normalise_columns(df).columns == ["fiscal_year", "a_b"]


def test_repaired_header(one):
    cells = F.array(*[F.lit(c).cast("string") for c in ["x", None, "x", "", "y", "x"]])
    assert one(names.repaired_header(cells)) == ["x", "Unnamed: 1", "x.1", "Unnamed: 3", "y", "x.2"]


@pytest.mark.parametrize(
    "name, month",
    [
        ("enrollment-by-county-final-april-2024.xlsx", date(2024, 4, 1)),
        ("x-Sept-2025.xlsx", date(2025, 9, 1)),
        ("x-jul-2024.jsonl", date(2024, 7, 1)),
    ],
)
def test_strict_month(one, name, month):
    assert one(names.month_from_name("n"), n=name) == month


@pytest.mark.parametrize("name", ["x-january-2024.xlsx", "x-2024.xlsx", "x.xlsx", "x-may-soon.xlsx"])
def test_strict_month_raises(one, name):
    with pytest.raises(Exception, match="no month in file name"):
        one(names.month_from_name("n"), n=name)


@pytest.mark.parametrize(
    "name, month",
    [
        ("timeliness-medicaid-jan-2025.xlsx", date(2025, 1, 1)),
        ("timeliness-medicaid-April-2025.xlsx", date(2025, 4, 1)),
        ("timeliness-medicaid-September-2025.jsonl", date(2025, 9, 1)),
        ("timeliness-summary-2025.xlsx", None),
        ("notes.xlsx", None),
    ],
)
def test_lenient_month_skips(one, name, month):
    assert one(names.month_from_name("n", on_unknown="skip"), n=name) == month


def test_lenient_month_raises_on_a_word_that_is_no_month(one):
    with pytest.raises(Exception, match="no month in file name"):
        one(names.month_from_name("n", on_unknown="skip"), n="x-medicaid-final-2025.xlsx")


def test_sql_functions_follow_the_same_rules(spark):
    register_sql_functions(spark)
    row = spark.sql(
        """
        SELECT div0(3, 4) a, div0(3, 0) b, div0(NULL, 0) c, div0(3, NULL) d,
          epoch_micros_to_date(1756684799999999) e,
          date_to_epoch_micros(DATE '2025-09-01') f, round_to_long(-2.5) g
        """
    ).first()
    assert tuple(row) == (0.75, 0.0, None, None, date(2025, 8, 31), 1756684800000000, -3)
