"""Exact duplicates: group by a 128-bit hash of the content, and compare the bytes in each group.

A text's content is its UTF-8 bytes without white space. Rows are grouped by the hash; grouping the
distinct (hash, bytes) pairs is the comparison: a hash that has two different contents is a collision,
and its rows are grouped by their bytes instead. Copies meet in the map tasks first, so a group with a
third of all rows sends one content per task, and no task ever holds a group.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .rows import anti_rows, cells, field, freeze, texts_of

#: White space that doesn't count: [\x20\x09-\x0D].
IGNORED = b"\x20\x09\x0a\x0b\x0c\x0d"


def content_hash(content: bytes) -> bytes:
    import xxhash

    return xxhash.xxh3_128_digest(content)


def _hashed(texts: DataFrame, hash_of: Callable[[bytes], bytes], with_content: bool) -> DataFrame:
    """The rows of `texts` with hash and number of code points, or with hash and content."""

    def rows(batches):
        import pyarrow as pa

        for batch in batches:
            hashes, points, contents = [], [], []
            for body in cells(batch, "body"):
                content = body.translate(None, IGNORED)
                hashes.append(hash_of(content))
                if with_content:
                    contents.append(content)
                else:
                    points.append(len(body.decode("utf-8", "replace")))
            found = {"hash": pa.array(hashes, pa.binary())}
            if with_content:
                found["content"] = pa.array(contents, pa.binary())
            else:
                found["n_points"] = pa.array(points, pa.int64())
            yield pa.RecordBatch.from_pydict(
                {"row_key": field(batch, "row_key"), "doc_id": field(batch, "doc_id"), **found}
            )

    id_type = texts.schema["doc_id"].dataType.simpleString()
    last = "content binary" if with_content else "n_points bigint"
    return texts.mapInArrow(rows, f"row_key string, doc_id {id_type}, hash binary, {last}")


def _first() -> Column:
    """The row of a group that stays: most code points, then smallest id, a missing id last."""
    points = (-F.col("n_points")).alias("points")
    return F.min(F.struct(points, F.col("doc_id").isNull().alias("no_id"), "doc_id", "row_key")).alias("first")


def exact_groups(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    hash_of: Callable[[bytes], bytes] = content_hash,
) -> DataFrame:
    """One row per row of `docs`: row_key, doc_id, keep_id, group_size, kept, text_sha256.

    A missing text is an empty one; all texts without content are one group. Ids may be missing or
    repeated: of rows alike in length and id, one stays. An empty table gives no rows, and other
    columns are not looked at. `hash_of` is a parameter for tests of collisions.
    """
    texts = texts_of(docs, id_col, text_col)
    rows = freeze(_hashed(texts, hash_of, with_content=False))
    contents = _hashed(texts, hash_of, with_content=True).select("row_key", "hash", "content")
    hashes = (
        contents.groupBy("hash", "content").agg(F.count("*").alias("n"))
        .select("hash", F.sha2("content", 256).alias("sha"))
        .groupBy("hash").agg(F.count("*").alias("contents"), F.min("sha").alias("text_sha256"))
    )
    groups = freeze(
        rows.groupBy("hash").agg(F.count("*").alias("group_size"), _first()).join(hashes, "hash")
    )
    found = rows.join(groups.where("contents = 1"), "hash")
    collided = groups.where("contents > 1").select("hash")
    if not collided.isEmpty():
        apart = rows.join(contents.join(collided, "hash", "left_semi").drop("hash"), "row_key")
        split = apart.groupBy("hash", "content").agg(F.count("*").alias("group_size"), _first())
        split = split.withColumns({"contents": F.lit(1), "text_sha256": F.sha2("content", 256)})
        found = found.unionByName(apart.join(split, ["hash", "content"]).select(found.columns))
    return found.select(
        "row_key",
        "doc_id",
        F.col("first.doc_id").alias("keep_id"),
        "group_size",
        (F.col("first.row_key") == F.col("row_key")).alias("kept"),
        "text_sha256",
    )


def drop_exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of `docs` that stay, with all their columns: one of each group of equal contents."""
    return anti_rows(docs, exact_groups(docs, id_col, text_col).where("not kept").select("row_key"))
