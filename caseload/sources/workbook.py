"""Workbooks (.xlsx) as landed sheets: the rows of a sheet with their position and cells.

Files are read by Spark's own reader, from any store it reaches. One task decodes a workbook as a
stream: the sheet's XML is parsed out of the archive piece by piece and leaves in batches of rows, so
neither the sheet nor its XML is ever whole in memory. Shared strings are one block of bytes.
"""

from __future__ import annotations

import re
import sys
import zipfile
from array import array
from collections.abc import Iterable, Iterator
from datetime import datetime, timedelta
from io import BytesIO
from xml.parsers import expat
from xml.sax.saxutils import escape

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Workers get this module's functions by value, so that they need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

SCHEMA = "source_path STRING, source_file STRING, sheet STRING, row_idx INT, cells ARRAY<STRING>"
# Texts that stand for a missing cell.
MISSING = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>",
    "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)
# Numbers of the format's own date and time formats.
DATE_FORMATS = frozenset([*range(14, 23), *range(27, 37), *range(45, 48), *range(50, 59)])
#: Bytes of XML parsed at a time, rows of a batch, and rows held back while a sheet's width is unknown.
CHUNK = 1 << 16
BATCH = 2_000
HELD = 20_000

Row = tuple[int, dict[int, str]]


class Strings:
    """A workbook's shared strings, as one block of bytes and where each begins."""

    def __init__(self):
        self.block, self.starts = bytearray(), array("q", [0])

    def append(self, text: str) -> None:
        self.block += text.encode("utf-8", "surrogatepass")
        self.starts.append(len(self.block))

    def __getitem__(self, number: int) -> str:
        if not 0 <= number < len(self.starts) - 1:
            raise ValueError(f"no shared string {number}")
        return self.block[self.starts[number] : self.starts[number + 1]].decode("utf-8", "surrogatepass")


def _parse(stream, on_start, on_end, on_text=None) -> Iterator[None]:
    """Parse XML by pieces, giving way after each; names come without their namespace."""
    parser = expat.ParserCreate(namespace_separator=" ")
    parser.buffer_text = True
    parser.StartElementHandler = lambda name, attributes: on_start(_local(name), attributes)
    parser.EndElementHandler = lambda name: on_end(_local(name))
    if on_text is not None:
        parser.CharacterDataHandler = on_text
    while piece := stream.read(CHUNK):
        parser.Parse(piece, False)
        yield
    parser.Parse(b"", True)
    yield


def _local(name: str) -> str:
    return name[name.rfind(" ") + 1 :]


def _attribute(attributes: dict[str, str], name: str, default: str = "") -> str:
    """An attribute by its local name."""
    if name in attributes:
        return attributes[name]
    return next((v for k, v in attributes.items() if _local(k) == name), default)


class Workbook:
    """An open workbook: its sheets by name, and their rows."""

    def __init__(self, file):
        self.archive = zipfile.ZipFile(file)
        names, targets, self.epoch = [], {}, datetime(1899, 12, 30)

        def start(name, attributes):
            if name == "sheet":
                names.append((attributes["name"], _relation(attributes)))
            elif name == "workbookPr" and attributes.get("date1904", "0") in ("1", "true"):
                self.epoch = datetime(1904, 1, 1)

        def relation(name, attributes):
            if name == "Relationship":
                targets[attributes["Id"]] = attributes["Target"]

        self._read("xl/workbook.xml", start)
        self._read("xl/_rels/workbook.xml.rels", relation)
        self.sheets = {name: _path(targets[target]) for name, target in names if target in targets}
        self._strings: Strings | None = None
        self._dates: list[bool] | None = None

    def _read(self, path: str, start, end=lambda name: None, text=None) -> None:
        with self.archive.open(path) as stream:
            for _ in _parse(stream, start, end, text):
                pass

    def chosen(self, sheet: str | int | None) -> list[str]:
        """The names of the sheets asked for: one by name or place, or all."""
        names = list(self.sheets)
        if sheet is None:
            return names
        if isinstance(sheet, int):
            if not 0 <= sheet < len(names):
                raise ValueError(f"no sheet number {sheet}, there are {len(names)}")
            return [names[sheet]]
        if sheet not in self.sheets:
            raise ValueError(f"no sheet named {sheet!r}, there are {names}")
        return [sheet]

    @property
    def strings(self) -> Strings:
        if self._strings is None:
            self._strings, said, depth = Strings(), [], {"t": 0, "rPh": 0}

            def start(name, _):
                if name in depth:
                    depth[name] += 1
                elif name == "si":
                    said.clear()

            def end(name):
                if name in depth:
                    depth[name] -= 1
                elif name == "si":
                    self._strings.append(_unescaped("".join(said)))

            def text(data):
                # Reading aids beside the text are no part of it.
                if depth["t"] and not depth["rPh"]:
                    said.append(data)

            if "xl/sharedStrings.xml" in self.archive.namelist():
                self._read("xl/sharedStrings.xml", start, end, text)
        return self._strings

    @property
    def dates(self) -> list[bool]:
        """Whether a cell of each style is a date."""
        if self._dates is None:
            formats, self._dates, inside = {}, [], []

            def start(name, attributes):
                if name == "numFmt":
                    formats[int(attributes["numFmtId"])] = attributes["formatCode"]
                elif name == "cellXfs":
                    inside.append(name)
                elif name == "xf" and inside:
                    number = int(attributes.get("numFmtId", 0))
                    self._dates.append(is_date_format(number, formats.get(number)))

            def end(name):
                if name == "cellXfs":
                    inside.pop()

            if "xl/styles.xml" in self.archive.namelist():
                self._read("xl/styles.xml", start, end)
        return self._dates

    def rows(self, name: str, missing: Iterable[str] = MISSING) -> Iterator[tuple[int, list[str | None]]]:
        """(position, cells) of the rows of a sheet, all as wide as its last column with a value."""
        missing, held, width = frozenset(missing), [], 0
        stream = self._sparse(name, missing)
        for row in stream:
            held.append(row)
            width = max(width, max(row[1], default=-1) + 1)
            if len(held) >= HELD:
                # Too many rows to hold back: the width takes a reading of its own.
                for _, cells in stream:
                    width = max(width, max(cells, default=-1) + 1)
                held, stream = [], self._sparse(name, missing)
                break
        for part in (held, stream):
            for number, cells in part:
                yield number, [cells.get(i) for i in range(width)]

    def _sparse(self, name: str, missing: frozenset[str]) -> Iterator[Row]:
        """(position, cells by column) of each row element."""
        done: list[Row] = []
        row, cells, column, kind, style, said, listening = -1, {}, -1, "n", 0, [], 0
        columns: dict[str, int] = {}

        def start(tag, attributes):
            nonlocal row, cells, column, kind, style, listening
            if tag == "c":
                place = attributes.get("r")
                if place:
                    letters = place.rstrip("0123456789")
                    column = columns.get(letters, -1)
                    if column < 0:
                        column = columns[letters] = column_number(letters)
                else:
                    column += 1
                kind, style = attributes.get("t", "n"), int(attributes.get("s", 0))
                said.clear()
            elif tag == "v" or tag == "t":
                listening += 1
            elif tag == "rPh":
                listening -= 1
            elif tag == "row":
                row, cells, column = int(attributes.get("r", row + 2)) - 1, {}, -1

        def end(tag):
            nonlocal listening
            if tag == "v" or tag == "t":
                listening -= 1
            elif tag == "rPh":
                listening += 1
            elif tag == "c":
                if said:
                    value = self._value(kind, style, "".join(said))
                    if value is not None and value not in missing:
                        cells[column] = value
            elif tag == "row":
                done.append((row, cells))

        def text(data):
            if listening > 0:
                said.append(data)

        with self.archive.open(self.sheets[name]) as stream:
            for _ in _parse(stream, start, end, text):
                yield from done
                done.clear()

    def _value(self, kind: str, style: int, text: str) -> str | None:
        if kind == "s":
            return self.strings[int(text)]
        if kind == "n":
            dates = self.dates
            return date_text(text, self.epoch) if style < len(dates) and dates[style] else text
        if kind == "b":
            return "True" if text == "1" else "False"
        if kind == "d":
            return str(datetime.fromisoformat(text).replace(tzinfo=None))
        return None if kind == "e" else _unescaped(text)


def _relation(attributes: dict[str, str]) -> str:
    """A sheet's relation, whose name is `id` in a namespace of its own."""
    return next((v for k, v in attributes.items() if " " in k and _local(k) == "id"), "")


def _path(target: str) -> str:
    return target[1:] if target.startswith("/") else f"xl/{target}"


def _unescaped(text: str) -> str:
    """Characters that XML can't hold are written as _xHHHH_."""
    if "_x" not in text:
        return text
    return re.sub("_x([0-9A-Fa-f]{4})_", lambda m: chr(int(m[1], 16)), text)


def column_number(letters: str) -> int:
    """A is 0, Z is 25, AA is 26."""
    number = 0
    for letter in letters.upper():
        number = number * 26 + ord(letter) - 64
    return number - 1


def column_letters(number: int) -> str:
    letters = ""
    while number >= 0:
        number, last = number // 26 - 1, number % 26
        letters = chr(65 + last) + letters
    return letters


def is_date_format(number: int, code: str | None) -> bool:
    """Whether a number format shows days or times: its code has such a letter outside texts, colours
    and escaped characters."""
    if code is None:
        return number in DATE_FORMATS
    plain = re.sub(r'"[^"]*"|\\.|_.|\*.|\[(?!h+\]|m+\]|s+\])[^\]]*\]', "", code.lower().split(";")[0])
    return plain != "general" and re.search(r"[dmyhs]", plain) is not None


def date_text(text: str, epoch: datetime) -> str:
    """A day number as `2024-05-01 00:00:00`, to the millisecond. Numbers below 60 are a day later in the
    calendar that starts in 1900, which has a 29th of February that never was; what is no day stays."""
    try:
        days = float(text)
        if epoch.year == 1899 and days < 60:
            days += 1
        return str(epoch + timedelta(milliseconds=round(days * 86_400_000)))
    except (ValueError, OverflowError):
        return text


def decode_workbooks(
    files: DataFrame, sheet: str | int | None = 0, missing: Iterable[str] = MISSING
) -> DataFrame:
    """Rows (source_path, source_file, sheet, row_idx, cells) of a sheet of each workbook.

    `files` has source_path, source_file and content. `sheet` is a name, a place from 0, or None for all
    sheets, which then have paths of their own (`path#name`). A workbook without the sheet, or one that
    can't be read, is an error that names the file. Numbers stay as they are written, dates become
    `YYYY-MM-DD HH:MM:SS`, formulas are their last value, and error values and the texts of `missing`
    are null. Position and width are the sheet's: leading blank rows count, and cells are as many as there
    are columns up to the last one with a value.
    """
    missing = tuple(missing)

    def rows(batches):
        import pyarrow as pa

        kept: dict[str, list] = {name: [] for name in ("source_path", "source_file", "sheet", "row_idx", "cells")}
        types = (pa.string(), pa.string(), pa.string(), pa.int32(), pa.list_(pa.string()))

        def batch():
            made = pa.RecordBatch.from_pydict(
                {name: pa.array(values, kind) for (name, values), kind in zip(kept.items(), types, strict=True)}
            )
            for values in kept.values():
                values.clear()
            return made

        for found in batches:
            for path, file, content in zip(*(found.column(i) for i in range(3)), strict=True):
                try:
                    book = Workbook(pa.BufferReader(content.as_buffer()))
                    for name in book.chosen(sheet):
                        key = path.as_py() if sheet is not None else f"{path.as_py()}#{name}"
                        for number, cells in book.rows(name, missing):
                            for values, value in zip(
                                kept.values(), (key, file.as_py(), name, number, cells), strict=True
                            ):
                                values.append(value)
                            if len(kept["cells"]) >= BATCH:
                                yield batch()
                except (zipfile.BadZipFile, expat.ExpatError, KeyError, ValueError) as error:
                    raise ValueError(f"{path.as_py()} can't be read: {error}") from error
        if kept["cells"]:
            yield batch()

    return files.select("source_path", "source_file", "content").mapInArrow(rows, SCHEMA)


def read_workbooks(
    spark: SparkSession,
    path: str | list[str],
    sheet: str | int | None = 0,
    pattern: str = "*.xlsx",
    missing: Iterable[str] = MISSING,
) -> DataFrame:
    """A sheet of each workbook of a folder, or of these files, as `decode_workbooks` gives it.

    Files that an open program locks beside a workbook (`~$...`) are left out. A workbook is one task's.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(path)
    named = files.select(
        F.col("_metadata.file_path").alias("source_path"),
        F.col("_metadata.file_name").alias("source_file"),
        "content",
    )
    return decode_workbooks(named.where(~F.startswith("source_file", F.lit("~$"))), sheet, missing)


_NUMBER = re.compile(r"-?(0|[1-9][0-9]*)(\.[0-9]+)?(E-?[0-9]+)?")
_DAY = re.compile(r"([0-9]{4}-[0-9]{2}-[0-9]{2})( 00:00:00)?")
_NAMESPACE = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
_RELATIONS = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
_PACKAGE = "http://schemas.openxmlformats.org/package/2006"
_HEAD = '<?xml version="1.0" encoding="UTF-8" standalone="yes"?>\n'


def workbook_bytes(sheets: dict[str, Iterable[tuple[int, list[str | None]]]]) -> bytes:
    """A workbook of sheets given as (position, cells) in rising order.

    Texts that are plain numbers become numbers, days (`2024-05-01`) dates from 1900-03-01 on, and others
    shared strings. A sheet is written as it is read.
    """
    strings: dict[str, int] = {}
    out = BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as archive:
        for number, rows in enumerate(sheets.values(), 1):
            with archive.open(f"xl/worksheets/sheet{number}.xml", "w") as stream:
                stream.write(f'{_HEAD}<worksheet xmlns="{_NAMESPACE}"><sheetData>'.encode())
                for row, cells in rows:
                    written = "".join(
                        _cell(f"{column_letters(i)}{row + 1}", c, strings) for i, c in enumerate(cells) if c is not None
                    )
                    stream.write(f'<row r="{row + 1}">{written}</row>'.encode())
                stream.write(b"</sheetData></worksheet>")
        said = "".join(f'<si><t xml:space="preserve">{_escaped(text)}</t></si>' for text in strings)
        parts = {
            "xl/sharedStrings.xml": f'<sst xmlns="{_NAMESPACE}">{said}</sst>',
            "xl/styles.xml": f'<styleSheet xmlns="{_NAMESPACE}"><cellXfs><xf numFmtId="0"/><xf numFmtId="14"/></cellXfs></styleSheet>',
            "xl/workbook.xml": f'<workbook xmlns="{_NAMESPACE}" xmlns:r="{_RELATIONS}"><sheets>'
            + "".join(
                f'<sheet name="{escape(name, {chr(34): "&quot;"})}" sheetId="{i}" r:id="rId{i}"/>'
                for i, name in enumerate(sheets, 1)
            )
            + "</sheets></workbook>",
            "xl/_rels/workbook.xml.rels": _relations(
                [*((f"rId{i}", "worksheet", f"worksheets/sheet{i}.xml") for i in range(1, len(sheets) + 1)),
                 ("rIdS", "sharedStrings", "sharedStrings.xml"), ("rIdF", "styles", "styles.xml")]
            ),
            "_rels/.rels": _relations([("rId1", "officeDocument", "xl/workbook.xml")]),
            "[Content_Types].xml": f'<Types xmlns="{_PACKAGE}/content-types">'
            '<Default Extension="xml" ContentType="application/xml"/>'
            '<Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/>'
            + "".join(
                f'<Override PartName="/xl/{part}" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.{kind}+xml"/>'
                for part, kind in [
                    ("workbook.xml", "sheet.main"), ("sharedStrings.xml", "sharedStrings"), ("styles.xml", "styles"),
                    *((f"worksheets/sheet{i}.xml", "worksheet") for i in range(1, len(sheets) + 1)),
                ]
            )
            + "</Types>",
        }
        for path, text in parts.items():
            archive.writestr(path, _HEAD + text)
    return out.getvalue()


def _relations(rows: list[tuple[str, str, str]]) -> str:
    said = "".join(f'<Relationship Id="{i}" Type="{_RELATIONS}/{kind}" Target="{target}"/>' for i, kind, target in rows)
    return f'<Relationships xmlns="{_PACKAGE}/relationships">{said}</Relationships>'


def _escaped(text: str) -> str:
    odd = re.sub("_x(?=[0-9A-Fa-f]{4}_)", "_x005F_x", text)
    return escape(re.sub("[\x00-\x08\x0b\x0c\x0d\x0e-\x1f￾￿]", lambda m: f"_x{ord(m[0]):04X}_", odd))


def _cell(place: str, text: str, strings: dict[str, int]) -> str:
    if _NUMBER.fullmatch(text):
        return f'<c r="{place}"><v>{text}</v></c>'
    day = _DAY.fullmatch(text)
    if day and day[1] >= "1900-03-01":
        return f'<c r="{place}" s="1"><v>{(datetime.fromisoformat(day[1]) - datetime(1899, 12, 30)).days}</v></c>'
    return f'<c r="{place}" t="s"><v>{strings.setdefault(text, len(strings))}</v></c>'


def pack_workbooks(grid: DataFrame, sheet: str = "Sheet1") -> DataFrame:
    """Each sheet of `grid` as a workbook: source_path, source_file and content.

    A workbook is put together by one task, and a sheet has at most 2**20 rows.
    """

    def pack(key, rows):
        import pyarrow as pa

        rows = rows.sort_by("row_idx")
        pairs = zip(rows["row_idx"].to_pylist(), rows["cells"].to_pylist(), strict=True)
        content = workbook_bytes({sheet: pairs})
        return pa.table(
            {"source_path": [key[0].as_py()], "source_file": [key[1].as_py()], "content": [content]},
            schema=pa.schema([("source_path", pa.string()), ("source_file", pa.string()), ("content", pa.binary())]),
        )

    grouped = grid.select("source_path", "source_file", "row_idx", "cells").groupBy("source_path", "source_file")
    return grouped.applyInArrow(pack, "source_path STRING, source_file STRING, content BINARY")
