"""SimHash near-duplicates: BK-trees over distinct fingerprints, joined into components.

Fingerprints are grouped first, so copies are one fingerprint. Two fingerprints that differ in at most
`radius` bits agree in at least one of radius + 1 blocks of bits: a shard is all fingerprints with one
value in one block, and a shard's tree need only be searched by its own members. A shard with more
than SHARD members is cut again by the blocks of its other bits, until all are small, so a hot group
of near copies is split without losing a pair. Trees of many shards are built and searched together
in each task: children are keyed by their Hamming distance to the parent, and a search follows the
edges within the radius of its own distance. What leaves a task are chains through each shard's
components, not all pairs.

The trees travel by the shuffle to the tasks that search them, not in a broadcast variable: that would
take all fingerprints through the driver.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import components
from .rows import anti_rows, cells, field, freeze, texts_of

#: Most fingerprints of a shard that is not cut further.
SHARD = 1024
#: Queries searched together, and words hashed together.
TOGETHER = 4096
WORDS_BYTES = 1 << 20


def fingerprint(body: bytes, width: int = 3, seed: int = 42) -> int:
    """The unsigned 64-bit SimHash of a text's word shingles; 0 without words."""
    import re

    import xxhash

    gap, position, carried = re.compile(rb"[\x20\x09-\x0D]"), 0, []
    counts, total = np.zeros(64, np.int64), 0

    def count(shingles: list[bytes]) -> None:
        nonlocal total
        hashes = np.fromiter((xxhash.xxh64_intdigest(s, seed) for s in shingles), "<u8", len(shingles))
        total += len(hashes)
        for start in range(0, len(hashes), TOGETHER):
            bits = hashes[start : start + TOGETHER].view(np.uint8).reshape(-1, 8)
            np.add(counts, np.unpackbits(bits, axis=1, bitorder="little").sum(axis=0, dtype=np.int64), out=counts)

    while position < len(body):
        end = min(len(body), position + WORDS_BYTES)
        if end < len(body):
            found = gap.search(body, end)
            end = found.start() if found else len(body)
        words = carried + body[position:end].lower().split()
        position = end
        if len(words) >= width:
            count([b" ".join(s) for s in zip(*(words[i:] for i in range(width)), strict=False)])
        carried = words[max(0, len(words) - width + 1) :]
    if not total and carried:
        count([b" ".join(carried)])
    return int(np.packbits(2 * counts > total, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str, text_col: str, width: int) -> DataFrame:
    """row_key, doc_id and fingerprint (the 64 bits as a long) of every row."""
    texts = texts_of(docs, id_col, text_col)

    def rows(batches):
        import pyarrow as pa

        for batch in batches:
            found = [fingerprint(body, width) for body in cells(batch, "body")]
            yield pa.RecordBatch.from_pydict(
                {
                    "row_key": field(batch, "row_key"),
                    "doc_id": field(batch, "doc_id"),
                    "fingerprint": pa.array(np.array(found, np.uint64).view(np.int64)),
                }
            )

    id_type = texts.schema["doc_id"].dataType.simpleString()
    return texts.mapInArrow(rows, f"row_key string, doc_id {id_type}, fingerprint bigint")


def _blocks(free: int, parts: int) -> list[int]:
    """The set bits of `free`, cut into masks of nearly equal numbers of neighbouring bits."""
    bits = [b for b in range(64) if free >> b & 1]
    bounds = [round(i * len(bits) / parts) for i in range(parts + 1)]
    return [sum(1 << b for b in bits[x:y]) for x, y in zip(bounds, bounds[1:], strict=False)]


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def shards(distinct: DataFrame, radius: int, most: int = SHARD) -> DataFrame:
    """(mask, value, fingerprint): shards that together hold every pair within the radius.

    No shard has more than `most` members. Shards with one member are left in; they have no pair.
    """
    every, parts = (1 << 64) - 1, radius + 1
    frontier = distinct.select(
        "fingerprint", F.explode(F.array(*(F.lit(_signed(m)) for m in _blocks(every, parts)))).alias("mask")
    ).withColumn("value", F.col("fingerprint").bitwiseAND(F.col("mask")))
    masks, done = _blocks(every, parts), None
    while True:
        # A mask with few free bits can't have more than `most` members.
        open_masks = [m for m in masks if 1 << (64 - m.bit_count()) > most]
        hot = frontier.where(F.col("mask").isin([_signed(m) for m in open_masks]))
        hot = hot.groupBy("mask", "value").agg(F.count("*").alias("n")).where(F.col("n") > most)
        hot = freeze(hot.drop("n")) if open_masks else None
        if hot is None or hot.isEmpty():
            return frontier if done is None else done.unionByName(frontier)
        cold = frontier.join(hot, ["mask", "value"], "left_anti")
        done = cold if done is None else done.unionByName(cold)
        narrower = {m: _blocks(every & ~m, parts) for m in open_masks}
        children = F.create_map(
            *(x for m in open_masks for x in (F.lit(_signed(m)), F.array(*(F.lit(_signed(m | b)) for b in narrower[m]))))
        )
        frontier = frontier.join(hot, ["mask", "value"], "left_semi").select(
            "fingerprint", F.explode(children[F.col("mask")]).alias("mask")
        )
        frontier = frontier.withColumn("value", F.col("fingerprint").bitwiseAND(F.col("mask")))
        masks = sorted({m | b for m in open_masks for b in narrower[m]})


def grow_trees(tree: np.ndarray, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """BK-trees of all shards at once: the root of each fingerprint's tree, and (edge, child) sorted by edge.

    `tree` numbers the shards from 0, in order. A node is the place of its fingerprint. The edge from
    node p to its child at distance d is 65 p + d. All that wait at a node go down one edge together;
    the first of each edge becomes the child, the rest wait there.
    """
    first = np.flatnonzero(np.r_[True, tree[1:] != tree[:-1]])
    roots = first[tree]
    waiting = np.setdiff1d(np.arange(len(prints)), first, assume_unique=True)
    node, edges, children = roots[waiting], [], []
    while len(waiting):
        edge = node * 65 + np.bitwise_count(prints[waiting] ^ prints[node])
        order = np.argsort(edge, kind="stable")
        edge, waiting = edge[order], waiting[order]
        starts = np.flatnonzero(np.r_[True, edge[1:] != edge[:-1]])
        edges.append(edge[starts])
        children.append(waiting[starts])
        node = np.repeat(waiting[starts], np.diff(np.r_[starts, len(edge)]))
        rest = np.ones(len(edge), bool)
        rest[starts] = False
        waiting, node = waiting[rest], node[rest]
    edge = np.concatenate(edges) if edges else np.zeros(0, np.int64)
    child = np.concatenate(children) if children else np.zeros(0, np.int64)
    order = np.argsort(edge, kind="stable")
    return roots, edge[order], child[order]


def search_trees(prints, roots, edge, child, queries: np.ndarray, radius: int):
    """(query, node) pairs within the radius, level by level; only edges within the radius are followed."""
    node = roots[queries]
    while len(queries):
        distance = np.bitwise_count(prints[queries] ^ prints[node]).astype(np.int64)
        near = distance <= radius
        yield queries[near], node[near]
        low = np.searchsorted(edge, node * 65 + np.maximum(distance - radius, 0), side="left")
        high = np.searchsorted(edge, node * 65 + np.minimum(distance + radius, 64), side="right")
        n = high - low
        queries = np.repeat(queries, n)
        node = child[np.repeat(low - np.r_[0, np.cumsum(n)[:-1]], n) + np.arange(n.sum())]


def shard_chains(tree: np.ndarray, prints: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Chains through the components that the shards' trees find: (a, b) pairs of fingerprints."""
    roots, edge, child = grow_trees(tree, prints)
    label = np.arange(len(prints))
    for start in range(0, len(prints), TOGETHER):
        queries = np.arange(start, min(len(prints), start + TOGETHER))
        for a, b in search_trees(prints, roots, edge, child, queries, radius):
            while True:
                x, y = label[a], label[b]
                apart = x != y
                if not apart.any():
                    break
                a, b, x, y = a[apart], b[apart], x[apart], y[apart]
                np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
                while (label[label] != label).any():
                    label = label[label]
    order = np.lexsort((np.arange(len(label)), label))
    same = label[order][1:] == label[order][:-1]
    return prints[order][:-1][same], prints[order][1:][same]


def links(distinct: DataFrame, radius: int, most: int = SHARD) -> DataFrame:
    """Edges (a, b) between fingerprints that connect all and only those linked within the radius."""

    def rows(batches):
        import pyarrow as pa

        def chains(mask, value, prints):
            if len(prints) < 2:
                return None
            fresh = np.r_[True, (mask[1:] != mask[:-1]) | (value[1:] != value[:-1])]
            tree = np.cumsum(fresh) - 1
            shared = np.bincount(tree)[tree] > 1
            if not shared.any():
                return None
            tree = np.unique(tree[shared], return_inverse=True)[1]
            a, b = shard_chains(tree, prints[shared].view(np.uint64), radius)
            return pa.RecordBatch.from_pydict({"a": pa.array(a.view(np.int64)), "b": pa.array(b.view(np.int64))})

        held = [np.zeros(0, np.int64)] * 3
        for batch in batches:
            held = [
                np.concatenate([x, field(batch, n).to_numpy(zero_copy_only=False)])
                for x, n in zip(held, ("mask", "value", "fingerprint"), strict=True)
            ]
            if not len(held[0]):
                continue
            # The last shard may go on in the next batch.
            last = np.flatnonzero((held[0] != held[0][-1]) | (held[1] != held[1][-1]))
            cut = last[-1] + 1 if len(last) else 0
            if cut and (found := chains(*(x[:cut] for x in held))):
                yield found
            held = [x[cut:] for x in held]
        if found := chains(*held):
            yield found

    dealt = shards(distinct, radius, most).repartition("mask", "value").sortWithinPartitions("mask", "value")
    return dealt.mapInArrow(rows, "a bigint, b bigint")


def near_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3, radius: int = 2
) -> DataFrame:
    """One row per row of `docs`: row_key, doc_id, fingerprint (16 hex digits), component_id.

    component_id is the smallest id that links reach; missing ids are passed over, and a component
    without any id has none. A text that is missing or has no words has fingerprint zero and is
    linked like any other. Repeated rows share a fingerprint. An empty table gives no rows.
    """
    rows = freeze(fingerprints(docs, id_col, text_col, width))
    distinct = freeze(rows.groupBy("fingerprint").agg(F.min("doc_id").alias("low")))
    roots = components(links(distinct, radius)).withColumnRenamed("node", "fingerprint")
    rooted = distinct.join(roots, "fingerprint", "left")
    rooted = rooted.select("fingerprint", "low", F.coalesce("root", "fingerprint").alias("root"))
    lowest = rooted.groupBy("root").agg(F.min("low").alias("component_id"))
    found = freeze(rooted.join(lowest, "root").select("fingerprint", "component_id"))
    return rows.join(found, "fingerprint").select(
        "row_key",
        "doc_id",
        F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"),
        "component_id",
    )


def drop_near_copies(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3, radius: int = 2
) -> DataFrame:
    """The rows of `docs` that stay, with all columns: of each component the one with the smallest id."""
    groups = freeze(near_groups(docs, id_col, text_col, width, radius))
    same = F.col("doc_id").eqNullSafe(F.col("component_id"))
    # Of rows that repeat the smallest id, one stays.
    first = groups.where(same & F.col("component_id").isNotNull())
    first = first.groupBy("component_id").agg(F.min("row_key").alias("row_key"))
    without = groups.where(F.col("component_id").isNull())
    without = without.groupBy("fingerprint").agg(F.min("row_key").alias("row_key"))
    kept = first.select("row_key").unionByName(without.select("row_key"))
    return anti_rows(docs, groups.join(kept, "row_key", "left_anti").select("row_key"))
