"""A uniform random shuffle into shards of exact size, planned by a hypergeometric matrix.

How many rows each partition sends to each shard is drawn first: if all rows are shuffled uniformly,
these counts are multivariate hypergeometric, and drawing them for all partitions one after the other
gives exact shard sizes. Each partition then deals its rows by a random permutation with just these
counts, rows are exchanged, and a second random order places them in the shard. That order is sorted
in cells, ranges of the random key with a known number of rows, so no task holds a shard.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .rows import column, freeze

SHARDS = 16
#: Rows of a shard that are put in order together, about.
CELL_ROWS = 50_000
SEED = 20


def communication_matrix(counts: list[int], shards: int, seed: int) -> np.ndarray:
    """Rows that each partition sends to each shard; shard sizes differ by one at most."""
    rng = np.random.default_rng(seed)
    total = sum(counts)
    room = np.full(shards, total // shards, np.int64)
    room[rng.permutation(shards)[: total % shards]] += 1
    matrix = np.zeros((len(counts), shards), np.int64)
    for i, n in enumerate(counts):
        # The marginals method draws one shard after the other, and takes totals of any size.
        left, behind = n, int(room.sum())
        for s in range(shards):
            behind -= int(room[s])
            matrix[i, s] = _hypergeometric(rng, int(room[s]), behind, left)
            left -= matrix[i, s]
        room -= matrix[i]
    return matrix


def _hypergeometric(rng, good: int, bad: int, draws: int) -> int:
    """numpy draws for totals below a billion; above, by splitting the draws in two halves."""
    if good == 0 or draws == 0:
        return 0
    if bad == 0:
        return draws
    if good < 10**9 and bad < 10**9:
        return int(rng.hypergeometric(good, bad, draws))
    half = draws // 2
    if half == 0:
        return int(rng.random() < good / (good + bad))
    one = _hypergeometric(rng, good, bad, half)
    return one + _hypergeometric(rng, good - one, bad - (half - one), draws - half)


def shuffled_shards(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shards: int = SHARDS,
    cell_rows: int = CELL_ROWS,
    seed: int = SEED,
) -> DataFrame:
    """One row per row of `docs`: doc_id, size, text_crc32, law, shard, slot, grown_shard.

    The law is `rows`: shard sizes differ by one at most, slots are gapless from 0, and every order of
    the rows is equally likely. A missing text has no bytes. Rows may repeat, ids may be missing: a row
    is placed by where it lies, not by what is in it. An empty table gives no rows.
    """
    body = F.coalesce(column(text_col).cast("string"), F.lit("")).cast("binary")
    rows = freeze(
        docs.select(
            column(id_col).alias("doc_id"),
            (F.octet_length(body).cast("bigint") + 1).alias("size"),
            F.crc32(body).alias("text_crc32"),
        )
    )
    # The frozen frame's partitions and their order are files, so they are the same in every job.
    counted = rows.groupBy(F.spark_partition_id().alias("part")).agg(F.count("*").alias("n")).collect()
    counts = dict((r["part"], r["n"]) for r in counted)
    parts = sorted(counts)
    # A row of `shards` numbers for each partition of the input, whatever the number of rows.
    matrix = communication_matrix([counts[p] for p in parts], shards, seed)
    sent = docs.sparkSession.sparkContext.broadcast((np.array(parts), matrix))

    def deal(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        known, matrix = sent.value
        at = np.flatnonzero(known == part)
        counts = matrix[at[0]] if len(at) else np.zeros(shards, np.int64)
        rng = np.random.default_rng([seed, part])
        shard = rng.permutation(np.repeat(np.arange(shards, dtype=np.int32), counts))
        at = 0
        for batch in batches:
            n = batch.num_rows
            found = dict(zip(batch.schema.names, batch.columns, strict=True))
            found["shard"] = pa.array(shard[at : at + n])
            found["place"] = pa.array(rng.integers(0, 1 << 62, n))
            found["part"] = pa.array(np.full(n, part, np.int32))
            yield pa.RecordBatch.from_pydict(found)
            at += n

    id_type = rows.schema["doc_id"].dataType.simpleString()
    dealt = rows.mapInArrow(
        deal, f"doc_id {id_type}, size bigint, text_crc32 bigint, shard int, place bigint, part int"
    )
    # At least as many cells as keep a big shard's order in small tasks.
    cells = max(8, -(-sum(counts.values()) // (shards * cell_rows)))
    width = -(-(1 << 62) // cells)
    dealt = dealt.withColumn("cell", F.expr(f"place div {width}L"))
    before = Window.partitionBy("shard").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        dealt.groupBy("shard", "cell").agg(F.count("*").alias("n"))
        .select("shard", "cell", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    )
    order = Window.partitionBy("shard", "cell").orderBy("place", "part", "text_crc32", "size", "doc_id")
    return (
        dealt.withColumn("rank", F.row_number().over(order) - 1)
        .join(offsets, ["shard", "cell"])
        .select(
            "doc_id",
            "size",
            "text_crc32",
            F.lit("rows").alias("law"),
            "shard",
            (F.col("offset") + F.col("rank")).alias("slot"),
            F.lit(None).cast("int").alias("grown_shard"),
        )
    )
