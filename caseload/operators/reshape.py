"""Wide tables and sheet layouts turned into long rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.names import normalised, repaired_header

# The columns that tell sheets apart, see `sources.grid`.
SHEET = ["source_path", "source_file"]


def wide_to_long(
    df: DataFrame,
    ids: Sequence[str],
    values: Sequence[str],
    name: str,
    value: str,
    *,
    keep_nulls: bool = False,
    only: Sequence[str] | None = None,
) -> DataFrame:
    """One row per id and value column; cells without a value give no row.

    A derived total is left out by not listing it. `only` narrows the list: a filter on the
    resulting name would not reach the scan, a shorter list does.
    """
    chosen = [c for c in values if only is None or c in only]
    long = df.unpivot(list(ids), chosen, name, value)
    return long if keep_nulls else long.where(F.col(value).isNotNull())


def union_by_name(first: DataFrame, *others: DataFrame) -> DataFrame:
    """UNION ALL by column name; a column that one side lacks is NULL there."""
    for other in others:
        first = first.unionByName(other, allowMissingColumns=True)
    return first


def stack_sections(
    grid: DataFrame,
    tags: Sequence[str],
    key: str,
    *,
    gap: int = 1,
    end: str = "TOTAL",
    level: str = "basic",
    name: str = "record_type",
) -> DataFrame:
    """Rows of several tables in one sheet, with the table they belong to and its header.

    A table starts with a row that has a cell named `key`; the tables of a sheet get the tags in
    order. Its rows start after `gap` more rows, and go on to the last row before the next
    header whose key is `end`, or else to that header: nothing depends on how many there are.
    Adds the tag, `header_row`, `header` (see `cell`) and `reason`, which is missing for the
    table's rows and tells why another row is none. Header rows and rows above the first are
    left out. One pass: windows over a sheet, which its format limits to 2**20 rows.
    """
    is_header = F.exists("cells", lambda c: normalised(c, level).eqNullSafe(F.lit(key)))
    names = F.transform(repaired_header(F.col("cells")), lambda c: normalised(c, level))
    above = (
        Window.partitionBy("source_path").orderBy("row_idx").rowsBetween(Window.unboundedPreceding, -1)
    )
    head = F.when(is_header, F.struct(F.col("row_idx").alias("row"), names.alias("names")))
    found = grid.select(
        "*",
        is_header.alias("__is_header"),
        F.count(head).over(above).alias("__number"),
        F.last(head, ignorenulls=True).over(above).alias("__head"),
    )
    found = found.where(~F.col("__is_header") & (F.col("__number") > 0)).select(
        *grid.columns,
        F.get(F.array(*map(F.lit, tags)), F.col("__number").cast("int") - 1).alias(name),
        F.col("__head.row").alias("header_row"),
        F.col("__head.names").alias("header"),
    )
    is_end = F.trim(cell(key)) == end
    last = F.max(F.when(is_end, F.col("row_idx"))).over(
        Window.partitionBy("source_path", "header_row")
    )
    return found.withColumn("__last", last).select(
        *found.columns,
        F.when(F.col(name).isNull(), "a table too many")
        .when(F.col("row_idx") <= F.col("header_row") + gap, "directly under the header")
        .when(is_end, "total row")
        .when(F.col("row_idx") > F.col("__last"), "after the total row")
        .alias("reason"),
    )


def with_header(
    body: DataFrame, grid: DataFrame, header_rows: Sequence[int], level: str = "full"
) -> DataFrame:
    """Give each body row the `header` of its own sheet, with names repaired and normalised.

    `body` holds rows of `grid` and the `header_row` they go under. Sheets may order or name
    their columns differently: cells are then picked by name, see `cell`. Headers, one row
    per sheet and table, stay data: none passes through the driver.
    """
    names = F.transform(repaired_header(F.col("cells")), lambda c: normalised(c, level))
    headers = grid.where(F.col("row_idx").isin(list(header_rows))).select(
        F.col("source_path"), F.col("row_idx").alias("header_row"), names.alias("header")
    )
    return body.join(headers, ["source_path", "header_row"], "left")


def cell(name: str) -> Column:
    """The cell under a header name; NULL where the sheet has no such column."""
    return F.get(F.col("cells"), F.array_position(F.col("header"), F.lit(name)).cast("int") - 1)


def under_header(grid: DataFrame, header_row: int, level: str = "full") -> DataFrame:
    """Rows below `header_row`, with the names of their own sheet's header in `header`, see `cell`.

    One pass: a window over a sheet, which its format limits to 2**20 rows.
    """
    names = F.transform(repaired_header(F.col("cells")), lambda c: normalised(c, level))
    header = F.max(F.when(F.col("row_idx") == header_row, names)).over(Window.partitionBy("source_path"))
    found = grid.where(F.col("row_idx") >= header_row).withColumn("header", header)
    return found.where(F.col("row_idx") > header_row)


def block_rows(
    grid: DataFrame, *, header_row: int, first_row: int, height: int, closing: str | None = None
) -> DataFrame:
    """Rows of a matrix of equal blocks, with what `block_cells` needs of their sheet.

    Blocks are `height` rows high and fill the sheet from `first_row` to its end, or up to the row
    whose first cell is `closing`; rows from there on have a `reason`. Adds `block_columns` (the names
    of the header row, without its first and last cell), `block_name` (the first cell of a block's
    first row) and `block_offset`. One pass: windows over a sheet.
    """
    below = F.col("row_idx") >= first_row
    position, first_cell = F.col("row_idx") - first_row, F.get("cells", F.lit(0))
    sheet = Window.partitionBy("source_path")
    ends = F.min(F.when(below & (F.trim(first_cell) == closing), F.col("row_idx"))) if closing else None
    found = (
        grid.where(below | (F.col("row_idx") == header_row))
        .withColumns({"__number": F.floor(position / height), "block_offset": F.pmod(position, F.lit(height))})
        .withColumns(
            {
                "block_columns": F.max(
                    F.when(F.col("row_idx") == header_row, _inner_cells(F.col("cells")))
                ).over(sheet),
                "block_name": F.max(F.when(below & (F.col("block_offset") == 0), first_cell)).over(
                    Window.partitionBy("source_path", "__number")
                ),
                "__end": F.lit(None).cast("int") if ends is None else ends.over(sheet),
            }
        )
    )
    reason = F.when(F.col("row_idx") >= F.col("__end"), "after the last block")
    return found.where(below).withColumn("reason", reason).drop("__number", "__end")


def block_cells(
    rows: DataFrame, *, labels: Sequence[Mapping[str, str]], block: str, column: str, value: str
) -> DataFrame:
    """Cells of the rows that `block_rows` gives as rows (sheet, block, labels, column, value).

    `labels` names a block's rows by offset. The last column is a total and is left out, and so are
    cells without a value, such as all those of a note.
    """
    by_offset = F.array(
        *[F.struct(*[F.lit(v).alias(k) for k, v in label.items()]) for label in labels]
    )
    # Names and labels are settled per row, before the row becomes as many rows as cells.
    pairs = F.arrays_zip("block_columns", "__values")
    settled = rows.withColumn("__values", _inner_cells(F.col("cells"))).select(
        *SHEET,
        F.col("block_name").alias(block),
        F.get(by_offset, F.col("block_offset")).alias("__label"),
        F.filter(pairs, lambda pair: pair["__values"].isNotNull()).alias("__pairs"),
    )
    return settled.withColumn("__cell", F.explode("__pairs")).select(
        *SHEET,
        block,
        *[F.col("__label")[name].alias(name) for name in labels[0]],
        F.col("__cell")["block_columns"].alias(column),
        F.col("__cell")["__values"].alias(value),
    )


def decode_blocks(
    grid: DataFrame,
    *,
    header_row: int,
    first_row: int,
    labels: Sequence[Mapping[str, str]],
    block: str,
    column: str,
    value: str,
    closing: str | None = None,
) -> DataFrame:
    """Cells of a matrix of equal blocks as rows, see `block_rows` and `block_cells`."""
    rows = block_rows(
        grid, header_row=header_row, first_row=first_row, height=len(labels), closing=closing
    )
    return block_cells(
        rows.where("reason IS NULL"), labels=labels, block=block, column=column, value=value
    )


def _inner_cells(cells: Column) -> Column:
    """All cells but the first (a label) and the last (a total)."""
    return F.slice(cells, F.lit(2), F.greatest(F.size(cells) - 2, F.lit(0)))
