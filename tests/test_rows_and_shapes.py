from __future__ import annotations

from pyspark.sql import functions as F

from caseload.operators import rows
from caseload.operators.reshape import (
    decode_blocks,
    stack_sections,
    union_by_name,
    wide_to_long,
    with_header,
    cell,
)

GRID = "source_path STRING, source_file STRING, row_idx INT, cells ARRAY<STRING>"


def sheet(spark, lines, name="s"):
    return spark.createDataFrame([(name, name, i, cells) for i, cells in lines], GRID)


def test_filters_on_missing_values(spark):
    df = spark.createDataFrame([("TOTAL",), (" MEPD ",), ("01",), (None,)], "r STRING")

    def left(out):
        return {r.r for r in out.collect()}

    assert left(rows.drop_value(df, "r", "TOTAL")) == {" MEPD ", "01", None}
    assert left(rows.drop_listed(df, "r", ["MEPD"])) == {"TOTAL", "01"}
    assert left(rows.missing_rows(df, "r")) == {None}


def test_drop_any_value_keeps_missing(spark):
    data = [("TOTAL", "x"), ("y", "TOTAL"), (None, "x"), ("y", None), ("TOTAL", None)]
    df = spark.createDataFrame(data, "a STRING, b STRING")
    out = rows.drop_any_value(df, {"a": "TOTAL", "b": "TOTAL"})
    assert {tuple(r) for r in out.collect()} == {(None, "x"), ("y", None)}


def test_keep_numeric_key(spark):
    df = spark.createDataFrame([("1",), ("255.0",), ("NaN",), ("1d",), ("Total",), (None,)], "k STRING")
    assert sorted(r.k for r in rows.keep_numeric_key(df, "k").collect()) == [1, 255]


def test_wide_to_long_drops_missing_cells_and_unlisted_totals(spark):
    df = spark.createDataFrame([(1, 9.0, 4.0, 5.0), (2, 3.0, 3.0, None)], "id INT, total DOUBLE, a DOUBLE, b DOUBLE")
    long = wide_to_long(df, ["id"], ["a", "b"], "name", "value")
    assert {tuple(r) for r in long.collect()} == {(1, "a", 4.0), (1, "b", 5.0), (2, "a", 3.0)}
    assert long.agg(F.sum("value")).first()[0] == df.agg(F.sum("total")).first()[0]
    assert wide_to_long(df, ["id"], ["a", "b"], "name", "value", keep_nulls=True).count() == 4
    only = wide_to_long(df, ["id"], ["a", "b"], "name", "value", only=["b"])
    assert {tuple(r) for r in only.collect()} == {(1, "b", 5.0)}


def test_union_by_name_fills_missing_columns(spark):
    a = spark.createDataFrame([(1, "x")], "k INT, only_a STRING")
    b = spark.createDataFrame([(2.5, 2)], "only_b DOUBLE, k INT")
    assert {tuple(r) for r in union_by_name(a, b).collect()} == {(1, "x", None), (2, None, 2.5)}


def test_sections_go_on_to_their_last_total_or_the_next_header(spark):
    rows = ["title", "Region", "gap", "a", "TOTAL", "b", "TOTAL", "note", "region", "gap", "c", "d", "Region", "gap", "e"]
    grid = sheet(spark, [(i, [None, text]) for i, text in enumerate(rows)])
    out = stack_sections(grid, ["one", "two"], "region", name="tag")
    got = {(r.tag, r.row_idx, r.header_row, r.reason) for r in out.collect()}
    assert got == {
        ("one", 2, 1, "directly under the header"), ("one", 3, 1, None), ("one", 4, 1, "total row"),
        ("one", 5, 1, None), ("one", 6, 1, "total row"), ("one", 7, 1, "after the total row"),
        ("two", 9, 8, "directly under the header"), ("two", 10, 8, None), ("two", 11, 8, None),
        (None, 13, 12, "a table too many"), (None, 14, 12, "a table too many"),
    }


def test_cells_by_name_in_sheets_of_different_order(spark):
    grid = sheet(spark, [(0, ["A", "B"]), (1, ["1", "2"])], "x").union(
        sheet(spark, [(0, ["B", "C", "A"]), (1, ["3", "4", "5"]), (2, ["6"])], "y")
    )
    body = grid.where("row_idx > 0").withColumn("header_row", F.lit(0))
    out = with_header(body, grid, [0]).select("source_file", "row_idx", *[cell(c).alias(c) for c in "abc"])
    assert {tuple(r) for r in out.collect()} == {
        ("x", 1, "1", "2", None),
        ("y", 1, "5", "3", "4"),
        ("y", 2, None, "6", None),
    }


LABELS = [{"p": "TOTAL"}, {"p": "one"}, {"p": "two"}]


def test_decode_blocks(spark):
    grid = sheet(
        spark,
        [
            (0, ["title", None, None, None]),
            (1, [None, "east", "west", "Total"]),
            (2, ["A\nCo", "3", "4", "7"]),
            (3, ["x", "1", None, "1"]),
            (4, ["x", "2", "4", "6"]),
            (5, ["B", "5", None, "5"]),
            (6, ["x", None, None, None]),
            (7, ["x", "5", None, "5"]),
            (8, ["All", "8", "4", "12"]),
        ],
    )
    out = decode_blocks(
        grid, header_row=1, first_row=2, closing="All", labels=LABELS, block="n", column="c", value="v"
    )
    assert {tuple(r)[2:] for r in out.collect()} == {
        ("A\nCo", "TOTAL", "east", "3"),
        ("A\nCo", "TOTAL", "west", "4"),
        ("A\nCo", "one", "east", "1"),
        ("A\nCo", "two", "east", "2"),
        ("A\nCo", "two", "west", "4"),
        ("B", "TOTAL", "east", "5"),
        ("B", "two", "east", "5"),
    }


def test_decode_blocks_keeps_sheets_apart(spark):
    def lines(east, name, value):
        return [(1, [None, east, "T"]), (2, [name, value, "0"]), (3, ["x", value, "0"]), (4, ["x", value, "0"])]

    grid = sheet(spark, lines("e1", "A", "1"), "x").union(sheet(spark, lines("e2", "B", "2"), "y"))
    out = decode_blocks(
        grid, header_row=1, first_row=2, labels=LABELS, block="n", column="c", value="v"
    )
    assert {(r.source_file, r.n, r.c, r.v) for r in out.collect()} == {
        ("x", "A", "e1", "1"),
        ("y", "B", "e2", "2"),
    }


def test_a_sheet_of_ten_thousand_blocks(spark):
    blocks = spark.range(10_000).selectExpr(
        "CAST(id AS STRING) AS name",
        "inline(transform(array(0, 1, 2), o -> struct(CAST(2 + 3 * id + o AS INT) AS row_idx, o)))",
    )
    data = blocks.selectExpr(
        "'s' AS source_path", "'s' AS source_file", "row_idx",
        "array(if(o = 0, name, 'x'), CAST(o AS STRING), '9') AS cells",
    )
    frame = sheet(spark, [(1, [None, "east", "T"]), (30_002, ["All", "1", "1"]), (30_003, ["z", "1", "1"])], "s")
    out = decode_blocks(
        data.unionByName(frame), header_row=1, first_row=2, closing="All", labels=LABELS, block="n", column="c", value="v"
    )
    assert out.count() == 30_000
    assert out.selectExpr("count(DISTINCT n) AS n").first().n == 10_000
    assert {tuple(r)[2:] for r in out.where("n = '777'").collect()} == {
        ("777", "TOTAL", "east", "0"), ("777", "one", "east", "1"), ("777", "two", "east", "2"),
    }


def test_a_key_out_of_range_is_no_key(spark):
    df = spark.createDataFrame([("1",), ("1e30",), ("-1e30",), ("9e18",)], "k STRING")
    assert sorted(r.k for r in rows.keep_numeric_key(df, "k").collect()) == [1, 9 * 10**18]
