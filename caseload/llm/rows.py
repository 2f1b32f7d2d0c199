"""Helpers shared by the operators: row keys, frozen frames, and text cells of Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_root


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def column(name: str) -> Column:
    """A column by its exact name, dots and blanks included."""
    return F.col(f"`{name.replace('`', '``')}`")


def row_key(df: DataFrame) -> Column:
    """A key for each row, the same whenever the frame is read again.

    Rows of files are named by file and place, so the key doesn't depend on how many cores a read
    is planned for. Other frames, among them those that repeat rows of files (explode, joins, unions),
    are numbered by partition; they must be deterministic.
    """
    try:
        df.select("_metadata.row_index")
        named = _reads_files(df)
    except AnalysisException:
        named = False
    if not named:
        return F.concat(F.lit("m:"), F.monotonically_increasing_id().cast("string"))
    return F.concat(
        F.hex(F.xxhash64("_metadata.file_path")), F.lit(":"), F.col("_metadata.row_index").cast("string")
    )


#: Steps of a plan that neither repeat rows nor make new ones.
_ROW_BY_ROW = frozenset(
    "Project Filter SubqueryAlias View LocalLimit GlobalLimit Sort RepartitionByExpression Repartition ResolvedHint".split()
)


def _reads_files(df: DataFrame) -> bool:
    """Whether each row of the frame is one row of one file."""
    plan = df._jdf.queryExecution().analyzed()
    while plan.nodeName() in _ROW_BY_ROW:
        plan = plan.children().head()
    return plan.children().isEmpty() and plan.nodeName() == "LogicalRelation"


def fresh_name(df: DataFrame, name: str) -> str:
    """`name`, or the first of name_1, name_2 ... that is no column of the frame."""
    taken = {c.lower() for c in df.columns}
    number, found = 0, name
    while found.lower() in taken:
        number += 1
        found = f"{name}_{number}"
    return found


def texts_of(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """row_key, doc_id and the UTF-8 bytes of the text, a missing text as an empty one."""
    return df.select(
        row_key(df).alias("row_key"),
        column(id_col).alias("doc_id"),
        F.coalesce(column(text_col).cast("string"), F.lit("")).cast("binary").alias("body"),
    )


def numbered(df: DataFrame, text_col: str) -> tuple[DataFrame, str]:
    """The frame with columns c0, c1 ... so that no name matters, and the name of its text as a string.

    `.select("c0", ...).toDF(*df.columns)` is the frame again.
    """
    names = [f"c{i}" for i in range(len(df.columns))]
    renamed, text = df.toDF(*names), f"c{df.columns.index(text_col)}"
    if renamed.schema[text].dataType.typeName() == "string":
        return renamed, text
    return renamed.withColumn("text", F.col(text).cast("string")), "text"


def anti_rows(df: DataFrame, dropped: DataFrame) -> DataFrame:
    """The rows of `df` whose row_key is not in the one column of `dropped`; all columns stay."""
    name = fresh_name(df, "row_key")
    keyed = df.withColumn(name, row_key(df))
    return keyed.join(dropped.toDF(name), name, "left_anti").drop(name)


def freeze(df: DataFrame) -> DataFrame:
    """The frame, computed once and written to the folder the cluster names in spark.checkpoint.dir.

    Lineage ends there, so a lost executor loses nothing. Where that setting is missing, the folder
    is one in the warehouse, which all executors share too.
    """
    context = df.sparkSession.sparkContext
    if not context.getCheckpointDir():
        context.setCheckpointDir(shared_root(df.sparkSession))
    return df.checkpoint(eager=True)


def cells(batch: pa.RecordBatch, name: str) -> Iterator[bytes]:
    """The bytes of a text or binary column's cells one after the other, a missing one as empty."""
    for cell in batch.column(batch.schema.get_field_index(name)):
        buffer = cell.as_buffer()
        yield buffer.to_pybytes() if buffer is not None else b""


def field(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def slices(batches, name: str, limit: int) -> Iterator[pa.RecordBatch]:
    """The batches, cut so that a piece has at most `limit` bytes of a binary column, or one row."""
    import numpy as np

    for batch in batches:
        array = field(batch, name)
        if not len(array):
            continue
        sizes = np.array([0 if n is None else n for n in _lengths(array)], dtype=np.int64)
        ends, start = np.cumsum(sizes), 0
        while start < len(sizes):
            base = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, base + limit, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


def _lengths(array: pa.Array) -> list:
    import pyarrow.compute as pc

    return pc.binary_length(array).to_pylist()
