"""Landed sheets: one JSON line per sheet row, holding its position and its cells.

A sheet is a file of its own, or its rows name it in `source_file`, so that a job can land any
number of sheets in files of even size. Cells are text and a missing cell is null.
`row_idx` is the position in the sheet: nothing depends on the order in which rows are read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMA = "row_idx INT, cells ARRAY<STRING>"


def read_grid(spark: SparkSession, path: str | list[str], pattern: str = "*") -> DataFrame:
    """Rows (source_path, source_file, row_idx, cells) of all files under a folder, or of these files."""
    read = spark.read.schema(SCHEMA).option("pathGlobFilter", pattern).json(path)
    return read.select(
        F.col("_metadata.file_path").alias("source_path"),
        F.col("_metadata.file_name").alias("source_file"),
        "row_idx",
        "cells",
    )


def read_named_grid(spark: SparkSession, path: str) -> DataFrame:
    """The same for rows that name their sheet, as `write_named_grid` lands them."""
    read = spark.read.schema(f"source_file STRING, {SCHEMA}").json(path)
    return read.select(F.col("source_file").alias("source_path"), "source_file", "row_idx", "cells")


def write_named_grid(grid: DataFrame, path: str) -> None:
    """Land sheets whose rows name them."""
    grid.select("source_file", "row_idx", "cells").write.mode("overwrite").json(path)
