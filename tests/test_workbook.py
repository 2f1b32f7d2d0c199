"""Workbooks read back, in whole and from XML written by hand, and loaded like landed sheets."""

from __future__ import annotations

import json
import zipfile
from datetime import datetime
from io import BytesIO

import pytest
from pyspark.sql import functions as F

from caseload.plans import raw
from caseload.plans.pipeline import SHEETS
from caseload.sources import workbook
from caseload.sources.grid import read_grid
from caseload.sources.workbook import (
    Workbook,
    column_letters,
    column_number,
    date_text,
    is_date_format,
    pack_workbooks,
    read_workbooks,
    workbook_bytes,
)
from landing import land_all

MAIN = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
OFFICE = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"


def rows_of(content, sheet=0):
    book = Workbook(BytesIO(content))
    return [list(book.rows(name)) for name in book.chosen(sheet)]


def by_hand(sheet_xml, strings="", styles="", properties="", target="worksheets/first.xml", prefix=""):
    """A workbook of one sheet from its parts."""
    out, colon = BytesIO(), f":{prefix}" if prefix else ""
    p = f"{prefix}:" if prefix else ""
    with zipfile.ZipFile(out, "w") as archive:
        archive.writestr(
            "xl/workbook.xml",
            f'<{p}workbook xmlns{colon}="{MAIN}" xmlns:r="{OFFICE}">{properties}'
            f'<{p}sheets><{p}sheet name="A &amp; B" sheetId="7" r:id="x1"/></{p}sheets></{p}workbook>',
        )
        archive.writestr(
            "xl/_rels/workbook.xml.rels", f'<Relationships><Relationship Id="x1" Target="{target}"/></Relationships>'
        )
        archive.writestr("xl/worksheets/first.xml", f'<{p}worksheet xmlns{colon}="{MAIN}">{sheet_xml}</{p}worksheet>')
        if strings:
            archive.writestr("xl/sharedStrings.xml", f'<sst xmlns="{MAIN}">{strings}</sst>')
        if styles:
            archive.writestr("xl/styles.xml", f'<styleSheet xmlns="{MAIN}">{styles}</styleSheet>')
    return out.getvalue()


def test_written_and_read_back():
    rows = [
        (0, ["Title", None, None, None]),
        (3, ["01", "1", "-2.50", "1E-7"]),
        (4, ["2024-05-01", "a & <b>\n", " blank ", "ünï 漢 \x07 _x0041_"]),
        (9, [None, None, "last", None]),
    ]
    found = rows_of(workbook_bytes({"One": iter(rows), "Two": iter([(0, ["x"])])}), None)
    expected = [(i, list(cells)) for i, cells in rows]
    expected[2][1][0] = "2024-05-01 00:00:00"
    assert found == [expected, [(0, ["x"])]]


def test_all_kinds_of_cells():
    styles = (
        '<numFmts><numFmt numFmtId="164" formatCode="[Red]0.0&quot;days&quot;"/>'
        '<numFmt numFmtId="165" formatCode="yyyy\\-mm"/></numFmts><cellStyleXfs><xf numFmtId="14"/></cellStyleXfs>'
        '<cellXfs><xf numFmtId="0"/><xf numFmtId="14"/><xf numFmtId="164"/><xf numFmtId="165"/><xf/></cellXfs>'
    )
    strings = "<si><t>plain</t></si><si><r><t>ri</t></r><r><t xml:space='preserve'>ch </t></r><rPh><t>no</t></rPh></si><si/>"
    sheet = (
        '<dimension ref="A1"/><sheetData><row r="2"><c r="A2" t="s"><v>0</v></c><c r="C2" t="s"><v>1</v></c>'
        '<c r="D2" t="s"><v>2</v></c></row>'
        '<row><c><v>1.50</v></c><c t="b"><v>1</v></c><c t="e"><v>#DIV/0!</v></c><c t="str"><f>A1</f><v>made</v></c>'
        '<c t="inlineStr"><is><r><t>in</t></r><r><t>line</t></r></is></c></row>'
        '<row r="7"><c r="A7" s="1"><v>45413</v></c><c r="B7" s="2"><v>45413</v></c><c r="C7" s="3"><v>45413.5</v></c>'
        '<c r="D7" s="4"><v>7</v></c><c r="E7" t="d"><v>2024-05-01T06:00:00</v></c><c r="AB7" s="9"/></row>'
        '<row r="8"/><row r="9"><c r="A9" t="str"><v>N/A</v></c></row></sheetData>'
    )
    assert rows_of(by_hand(sheet, strings, styles)) == [
        [
            (1, ["plain", None, "rich ", None, None]),
            (2, ["1.50", "True", None, "made", "inline"]),
            (6, ["2024-05-01 00:00:00", "45413", "2024-05-01 12:00:00", "7", "2024-05-01 06:00:00"]),
            (7, [None] * 5),
            (8, [None] * 5),
        ]
    ]


def test_prefixes_paths_and_the_other_epoch():
    sheet = '<m:sheetData><m:row r="1"><m:c r="A1" s="0"><m:v>1</m:v></m:c></m:row></m:sheetData>'
    styles = '<cellXfs><xf numFmtId="22"/></cellXfs>'
    book = by_hand(
        sheet, styles=styles, properties='<m:workbookPr date1904="1"/>', target="/xl/worksheets/first.xml", prefix="m"
    )
    assert rows_of(book) == [[(0, ["1904-01-02 00:00:00"])]]
    assert Workbook(BytesIO(book)).chosen("A & B") == ["A & B"]


def test_formats_columns_and_days():
    dates = [(14, None), (22, None), (164, "yyyy-mm-dd"), (165, "[h]:mm"), (166, '"on" d'), (167, "d;@")]
    others = [(0, None), (2, None), (164, "General"), (165, "0.00"), (166, '"day"0'), (167, "[Red]0"), (168, "\\d0"), (169, "0_d")]
    assert all(is_date_format(*f) for f in dates) and not any(is_date_format(*f) for f in others)
    for n in (0, 25, 26, 701, 702, 16383):
        assert column_number(column_letters(n)) == n
    assert (column_number("A"), column_number("XFD")) == (0, 16383)
    first = datetime(1899, 12, 30)
    assert [date_text(t, first) for t in ("1", "59", "61", "0.5", "x", "1e99")] == [
        "1900-01-01 00:00:00", "1900-02-28 00:00:00", "1900-03-01 00:00:00", "1899-12-31 12:00:00", "x", "1e99",
    ]


def test_sheets_longer_than_what_is_held_back(monkeypatch):
    rows = [(i, [str(i), None, "x" if i == 700 else None]) for i in range(1000)]
    content = workbook_bytes({"s": iter(rows)})
    whole = rows_of(content)
    monkeypatch.setattr(workbook, "HELD", 50)
    monkeypatch.setattr(workbook, "CHUNK", 999)
    assert rows_of(content) == whole == [[(i, list(c)) for i, c in rows]]


def as_workbooks(root, sheets):
    """The landed sheets of all tables, written as workbooks with a sheet of another name before theirs."""
    for table, folder in land_all(root).items():
        for file in (root / table).glob("*.jsonl"):
            lines = [json.loads(line) for line in file.read_text(encoding="utf-8").splitlines()]
            rows = sorted((r["row_idx"], r["cells"]) for r in lines)
            name = sheets[table]
            made = {name: rows} if name == 0 else {"About": [(0, ["about"])], name: rows}
            made = {str(k): v for k, v in made.items()}
            (root / table / f"{file.stem}.xlsx").write_bytes(workbook_bytes(made))
        (root / table / "~$locked.xlsx").write_bytes(b"no workbook")
    return {table: str(root / table) for table in sheets}


@pytest.fixture(scope="module")
def folders(tmp_path_factory):
    return as_workbooks(tmp_path_factory.mktemp("books"), SHEETS)


BUILDS = {
    "enrollment_by_risk_group": raw.enrollment_by_risk_group,
    "chip_enrollment_detail": raw.chip_enrollment_detail,
    "htw_enrollment": raw.htw_enrollment,
    "enrollment_by_county": raw.enrollment_by_county,
    "timeliness_medicaid": raw.timeliness_medicaid,
    "mco_enrollment_by_sda": raw.mco_enrollment_by_sda,
}


@pytest.mark.parametrize("table", list(BUILDS))
def test_raw_tables_equal_those_of_landed_lines(spark, folders, table):
    def loaded(grid):
        rows = BUILDS[table](grid.withColumn("source_file", F.regexp_replace("source_file", r"\.\w+$", ".xlsx")))
        return sorted(str(r) for r in rows.collect())

    from_lines = loaded(read_grid(spark, folders[table], "*.jsonl"))
    assert from_lines and loaded(read_workbooks(spark, folders[table], SHEETS[table])) == from_lines


def test_all_sheets_have_paths_of_their_own(spark, folders):
    found = read_workbooks(spark, folders["htw_enrollment"], None)
    assert {(r.sheet, r.source_path.split("#")[1]) for r in found.collect()} == {("About",) * 2, ("Summary",) * 2}


def test_errors_name_the_file(spark, folders, tmp_path):
    with pytest.raises(Exception, match=r"(?s)htw.xlsx can't be read: no sheet named 'Nowhere'"):
        read_workbooks(spark, folders["htw_enrollment"], "Nowhere").collect()
    (tmp_path / "broken.xlsx").write_bytes(b"PK no archive")
    with pytest.raises(Exception, match="broken.xlsx can't be read"):
        read_workbooks(spark, str(tmp_path)).collect()


def test_packed_by_spark(spark):
    grid = spark.createDataFrame(
        [("p1", "a.xlsx", 2, ["x", None, "3"]), ("p1", "a.xlsx", 0, ["h", "i", "j"]), ("p2", "b.xlsx", 1, ["only"])],
        "source_path string, source_file string, row_idx int, cells array<string>",
    )
    found = workbook.decode_workbooks(pack_workbooks(grid), "Sheet1").drop("sheet")
    assert sorted(map(str, found.collect())) == sorted(map(str, grid.collect()))
    assert workbook.decode_workbooks(pack_workbooks(grid.limit(0))).count() == 0
