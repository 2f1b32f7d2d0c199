"""A Merkle manifest of a dataset: hash trees by source under one root, with a proof for every row.

Leaves are numbered within their source by one range sort. SPAN consecutive leaves (a power of the
fan-out) are a subtree; subtrees are dealt to superblocks: one of a long source is a superblock, those of
short sources share some. Going up, each superblock is reduced to the roots of its subtrees, which are the
nodes of the next, SPAN times smaller round, until every source has one; sources are then the nodes of one
more tree. Going down, the nodes of a round are cogrouped by superblock with the outer nodes that their
proofs need (siblings above the subtree, found in the round before), and each node gets its own siblings
in front of them. In the last round the nodes are the leaves, and the same task folds their proofs.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .rows import column, freeze

FANOUT = 3
#: Leaves of a subtree: FANOUT to the power HEIGHT.
HEIGHT = 6
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def _joined(fields: list[Column]) -> Column:
    """sha256 of the fields: `-` for a missing one, else its UTF-8 byte count, a colon and its value."""
    parts = [
        F.coalesce(F.concat(F.octet_length(f).cast("string"), F.lit(":"), f), F.lit("-")) for f in fields
    ]
    return F.sha2(F.concat(*parts), 256)


def leaves(docs: DataFrame, id_col: str, tree_col: str, text_col: str, fields: tuple[str, ...]) -> DataFrame:
    """tree, doc_id, leaf, and spoiled: the leaf after the tampering."""
    values = {name: column(name).cast("string") for name in fields}
    halves = F.crc32(column(id_col).cast("string").cast("binary")) % 2 == 0
    changed = F.when(halves, F.replace(values[text_col], F.lit("\n"), F.lit(""))).otherwise(values[text_col])
    return docs.select(
        column(tree_col).cast("string").alias("tree"),
        column(id_col).alias("doc_id"),
        _joined([values[f] for f in fields]).alias("leaf"),
        _joined([changed if f == text_col else values[f] for f in fields]).alias("spoiled"),
    )


def numbered_in_order(rows: DataFrame, order: list[str]) -> DataFrame:
    """`rows` with pos, the place of each row in its tree (from 0), and total, the rows of the tree.

    Rows are dealt by ranges of (tree, order), so a long tree is many partitions; a partition knows its
    own places, and the counts of partitions are added up.
    """
    keys = [F.asc_nulls_first("tree"), *map(F.asc_nulls_first, order)]
    placed = rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
    placed = freeze(
        placed.withColumns({"part": F.spark_partition_id(), "at": F.monotonically_increasing_id()})
    )
    runs = placed.groupBy("part", "tree").agg(F.min("at").alias("first"), F.count("*").alias("n"))
    whole = Window.partitionBy("tree")
    before = whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select(
        F.col("part").alias("run_part"),
        F.col("tree").alias("run_tree"),
        (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first")).alias("shift"),
        F.sum("n").over(whole).alias("total"),
    )
    same = (F.col("part") == F.col("run_part")) & F.col("tree").eqNullSafe(F.col("run_tree"))
    joined = placed.join(runs, same)
    return joined.select(*rows.columns, (F.col("at") + F.col("shift")).alias("pos"), "total")


def _superblock(tree: str, block: Column, total: str, span: int, bundles: int) -> Column:
    """The group that works on a subtree. A number that falls together with another's does no harm."""
    own = F.xxhash64(F.col(tree), block)
    return F.when(F.col(total) > span, own).otherwise(F.pmod(F.xxhash64(tree), F.lit(bundles)))


def _dealt(nodes: DataFrame, span: int) -> tuple[DataFrame, int]:
    """The nodes with their superblock, and the number of groups that short trees share."""
    bundles = max(1, -(-nodes.count() // span))
    block = F.expr(f"pos div {span}L")
    return nodes.withColumn("superblock", _superblock("tree", block, "total", span, bundles)), bundles


def _digest(text: str) -> str:
    return sha256(text.encode()).hexdigest()


def _levels(nodes: list[str], height: int | None) -> list[list[str]]:
    """The nodes and all levels above them: `height` levels, or up to the one that is alone."""
    levels = [nodes]
    while len(levels) <= height if height is not None else len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([_digest("".join(below[i : i + FANOUT])) for i in range(0, len(below), FANOUT)])
    return levels


def _subtrees(frame, height: int) -> Iterator[tuple[np.ndarray, int, int, list[list[str]]]]:
    """Of a superblock's nodes, for each subtree: the places in the frame by position, the number of the
    subtree in its tree, the tree's total, and the levels."""
    import pandas as pd

    span = FANOUT**height
    code, _ = pd.factorize(frame["tree"], use_na_sentinel=False)
    pos, total = frame["pos"].to_numpy(), frame["total"].to_numpy()
    order = np.lexsort((pos, code))
    block = pos[order] // span
    starts = np.flatnonzero(np.r_[True, (np.diff(code[order]) != 0) | (np.diff(block) != 0)])
    nodes = frame["node"].to_numpy()
    for start, stop in zip(starts, [*starts[1:], len(order)], strict=True):
        at = order[start:stop]
        n = int(total[at[0]])
        yield at, int(block[start]), n, _levels(nodes[at].tolist(), height if n > span else None)


def _siblings(levels: list[list[str]], i: int) -> tuple[list[str], list[str]]:
    """What stands before and after a node and its ancestors in their runs, up to the last level's."""
    left, right = [], []
    for level in levels[:-1]:
        first = i - i % FANOUT
        left.append("".join(level[first:i]))
        right.append("".join(level[i + 1 : first + FANOUT]))
        i //= FANOUT
    return left, right


def _reduced(nodes: DataFrame, height: int) -> DataFrame:
    """The roots of all subtrees: tree, pos, total, below (the total they came from) and node."""
    span = FANOUT**height

    def roots(frame):
        import pandas as pd

        trees, rows = frame["tree"].to_numpy(), []
        for at, block, n, levels in _subtrees(frame, height):
            rows.append((trees[at[0]], block, -(-n // span), n, levels[-1][0]))
        return pd.DataFrame(rows, columns=["tree", "pos", "total", "below", "node"])

    found = nodes.select("superblock", "tree", "pos", "total", "node").groupBy("superblock")
    return found.applyInPandas(roots, "tree string, pos bigint, total bigint, below bigint, node string")


def _outer_of(frame) -> dict:
    """(tree, subtree) -> left and right siblings above it, and the rest of its row."""
    outer = {}
    for row in frame.itertuples(index=False):
        outer[None if row.tree is None else str(row.tree), int(row.pos)] = row
    return outer


def _descended(nodes: DataFrame, outer: DataFrame, height: int) -> DataFrame:
    """For each node its siblings up to the root: tree, pos, below, left, right."""

    def paths(frame, above):
        import pandas as pd

        known, trees, below = _outer_of(above), frame["tree"].to_numpy(), frame["below"].to_numpy()
        pos, rows = frame["pos"].to_numpy(), []
        for at, block, _, levels in _subtrees(frame, height):
            up = known[trees[at[0]], block]
            for i, k in enumerate(at.tolist()):
                left, right = _siblings(levels, i)
                rows.append((trees[k], pos[k], below[k], [*left, *up.left], [*right, *up.right]))
        return pd.DataFrame(rows, columns=["tree", "pos", "below", "left", "right"])

    schema = "tree string, pos bigint, below bigint, left array<string>, right array<string>"
    ours = nodes.select("superblock", "tree", "pos", "total", "below", "node").groupBy("superblock")
    return ours.cogroup(outer.groupBy("superblock")).applyInPandas(paths, schema)


def _climbed(nodes: DataFrame, height: int) -> tuple[list[tuple[DataFrame, int]], DataFrame]:
    """The rounds from these nodes up, each with its number of bundles, and the one root of each tree."""
    rounds = []
    while True:
        dealt, bundles = _dealt(nodes, FANOUT**height)
        rounds.append((dealt, bundles))
        nodes = freeze(_reduced(dealt, height))
        if nodes.where("total > 1").isEmpty():
            return rounds, nodes


def _for_round(paths: DataFrame, bundles: int, span: int) -> DataFrame:
    """Paths of nodes as the outer nodes of the subtrees that they are the roots of."""
    return paths.withColumn("superblock", _superblock("tree", F.col("pos"), "below", span, bundles))


def manifest(
    docs: DataFrame,
    id_col: str = "doc_id",
    tree_col: str = "source",
    text_col: str = "text",
    fields: tuple[str, ...] = FIELDS,
    height: int = HEIGHT,
    proofs: bool = True,
) -> DataFrame:
    """One row per row of `docs`: tree, doc_id, leaf, subroot, root, left, right (its siblings, level by
    level up to the root), proof_sha256, folded_root and verified. Without `proofs`, left and right are
    missing; they are the only columns that get longer with the number of rows.

    Leaves ascend by id, a missing id first, rows with one id by their hash; rows alike in all fields are
    leaves of their own. Missing sources are one tree, the first. A missing id is never tampered with. An
    empty table gives no rows. Columns that are not in `fields` are not looked at. Long texts are hashed
    where they lie; only hashes travel.
    """
    span = FANOUT**height
    found = numbered_in_order(freeze(leaves(docs, id_col, tree_col, text_col, fields)), ["doc_id", "leaf"])
    found = freeze(found.withColumnRenamed("leaf", "node"))
    rounds, subroots = _climbed(found.withColumn("below", F.lit(0).cast("bigint")), height)

    sources = subroots.select(F.lit("").alias("tree"), F.col("tree").alias("source"), "node", "below")
    sources = freeze(numbered_in_order(sources, ["source"]))
    top, roots = _climbed(sources, height)
    first = roots.first()
    root = first["node"] if first else ""

    none = F.array().cast("array<string>")
    outer = roots.select("tree", "pos", "below", none.alias("left"), none.alias("right"))
    for nodes, bundles in reversed(top):
        outer = _descended(nodes, _for_round(outer, bundles, span), height)
    # From the one tree of sources to the tree of each source.
    of_source = sources.select("source", F.col("pos").alias("place"), F.col("node").alias("subroot"))
    outer = outer.join(of_source, F.col("pos") == F.col("place"))
    outer = outer.select(F.col("source").alias("tree"), F.lit(0).cast("bigint").alias("pos"), "below", "left", "right")
    tops = of_source.select(F.col("source").alias("top_tree"), "subroot")
    for nodes, bundles in reversed(rounds[1:]):
        outer = _descended(nodes, _for_round(freeze(outer), bundles, span), height)
    outer = outer.join(tops, F.col("tree").eqNullSafe(F.col("top_tree"))).drop("top_tree")
    return _folded(rounds[0], outer, docs.schema[id_col].dataType.simpleString(), root, height, proofs)


def _folded(
    leaf_round: tuple[DataFrame, int], outer: DataFrame, id_type: str, root: str, height: int, proofs: bool
) -> DataFrame:
    """The last round: local reduction, joined proofs and folding, superblock by superblock."""
    nodes, bundles = leaf_round
    names = ["tree", "id", "leaf", "subroot", "proof_sha256", "folded_root", *(["left", "right"] if proofs else [])]

    def fold(frame, above):
        import pandas as pd

        known, trees = _outer_of(above), frame["tree"].to_numpy()
        ids, spoiled, rows = frame["id"].to_numpy(), frame["spoiled"].to_numpy(), []
        for at, block, _, levels in _subtrees(frame, height):
            up = known[trees[at[0]], block]
            outside = list(zip(up.left, up.right, strict=True))
            outer_proof = "".join(a + b for a, b in outside)
            for i, k in enumerate(at.tolist()):
                left, right = _siblings(levels, i)
                sides = ([*left, *up.left], [*right, *up.right]) if proofs else ()
                node, proof = spoiled[k], []
                for a, b in zip(left, right, strict=True):
                    node = _digest(a + node + b)
                    proof.append(a + b)
                for a, b in outside:
                    node = _digest(a + node + b)
                proof = _digest("".join(proof) + outer_proof)
                rows.append((trees[k], ids[k], levels[0][i], up.subroot, proof, node, *sides))
        return pd.DataFrame(rows, columns=names)

    # Ids travel as text: pandas has no whole numbers that may be missing.
    ours = nodes.select(
        "superblock", "tree", "pos", "total", "node", "spoiled", F.col("doc_id").cast("string").alias("id")
    )
    ours, theirs = ours.groupBy("superblock"), _for_round(outer, bundles, FANOUT**height).groupBy("superblock")
    schema = ", ".join(f"{n} {'array<string>' if n in ('left', 'right') else 'string'}" for n in names)
    return ours.cogroup(theirs).applyInPandas(fold, schema).select(
        "tree",
        F.col("id").cast(id_type).alias("doc_id"),
        "leaf",
        "subroot",
        F.lit(root).alias("root"),
        *names[6:],
        "proof_sha256",
        "folded_root",
        (F.col("folded_root") == F.lit(root)).alias("verified"),
    )
