"""Ranked lexical search with pair-bound MaxScore over an index in shards.

A shard is the inverted index of some documents: for each term the documents that hold it, with their
counts. All items of a block visit all shards, without a cross join: shards and copies of the blocks meet
in groups by a key. In a shard, items' terms are taken in pairs. For each pair the intersection of its two
lists is built beforehand, with its joint maximum impact: what a document with both terms gets at most. A
pair's bound is the largest of that and of each list's own maximum, mostly far below the sum of the two
maxima. Bounds of pairs combine to bounds of what is left of an item: once documents that hold only the
pairs left can't reach the ten best scores, only documents already met are looked up in their lists, and
those that can't reach them either are left out.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import count
from typing import NamedTuple

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import shared_folder
from .rows import cells, field, texts_of

BEST = 10
#: Text of a shard, and terms of a block of items.
SHARD_BYTES = 16 << 20
BLOCK_TERMS = 200_000
#: Long texts are cut into words a part at a time.
PART = 1 << 20
#: Letters and digits of ASCII and all bytes beyond it belong to terms; A-Z are lower-cased.
LETTERS = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256)
)


def terms_of(body: bytes) -> Iterator[list[bytes]]:
    """Lists of the terms of a text, part by part."""
    start = 0
    while start < len(body):
        stop = len(body)
        if stop - start > PART:
            # A part ends before a byte that is in no term.
            plain, at = b"", start + PART
            while at < len(body):
                plain = body[at : at + 256].translate(LETTERS)
                gap = plain.find(b" ")
                at += gap if gap >= 0 else len(plain)
                if gap >= 0:
                    break
            stop = at
        yield body[start:stop].translate(LETTERS).split()
        start = stop


class Shard:
    """Collects documents, and gives their inverted index as one row."""

    def __init__(self):
        # A new term gets the next number.
        self.vocabulary: defaultdict[bytes, int] = defaultdict()
        self.vocabulary.default_factory = self.vocabulary.__len__
        self.keys: list[np.ndarray] = []
        self.lengths: list[int] = []
        self.ids: list = []
        self.bytes = 0

    def add(self, doc_id, body: bytes) -> None:
        """One document; one without a term is not indexed."""
        found, vocabulary, n = [], self.vocabulary, 0
        for words in terms_of(body):
            found.append(np.fromiter(map(vocabulary.__getitem__, words), np.int64, len(words)))
            n += len(words)
        if n:
            self.keys += [(part << 32) | len(self.ids) for part in found]
            self.lengths.append(n)
            self.ids.append(doc_id)
            self.bytes += len(body)

    def row(self, name: str, id_type) -> dict:
        import pyarrow as pa
        import pyarrow.compute as pc

        ids = pa.array(self.ids, id_type)
        # Documents ascend by id, a missing one last, so that a tie goes to the lower place.
        order = pc.sort_indices(ids).to_numpy()
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        keys = np.concatenate(self.keys)
        keys, counts = np.unique((keys & ~0xFFFFFFFF) | place[keys & 0xFFFFFFFF], return_counts=True)
        starts = np.searchsorted(keys >> 32, np.arange(len(self.vocabulary) + 1))
        return {
            "shard": name,
            "docs": len(self.ids),
            "words": sum(self.lengths),
            "ids": ids.take(pa.array(order)),
            "lengths": np.array(self.lengths, np.int64)[order].tobytes(),
            "vocabulary": b" ".join(self.vocabulary),
            "starts": starts.astype(np.int64).tobytes(),
            "places": (keys & 0xFFFFFFFF).astype(np.int32).tobytes(),
            "counts": counts.astype(np.int32).tobytes(),
        }


def build_index(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shard_bytes: int = SHARD_BYTES
) -> DataFrame:
    """The index: one row per shard of about `shard_bytes` of text, or less.

    shard, docs and words (their numbers), ids (ascending), lengths (terms of each document), vocabulary
    (terms, by blanks), starts (of each term's list), places and counts (the lists). All arrays are
    little-endian numbers. Documents without a term are not in it; an empty table gives no rows.
    """
    texts = texts_of(docs, id_col, text_col)

    def rows(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        part, numbers, shard, id_type = TaskContext.get().partitionId(), count(), Shard(), None

        def batch_of():
            row = shard.row(f"{part}-{next(numbers)}", id_type)
            ids = row.pop("ids")
            columns = {name: pa.array([value]) for name, value in row.items()}
            columns["ids"] = pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids)
            return pa.RecordBatch.from_pydict({name: columns[name] for name in INDEX_COLUMNS})

        for batch in batches:
            id_type = field(batch, "doc_id").type
            for doc_id, body in zip(field(batch, "doc_id").to_pylist(), cells(batch, "body"), strict=True):
                shard.add(doc_id, body)
                if shard.bytes >= shard_bytes:
                    yield batch_of()
                    shard = Shard()
        if shard.ids:
            yield batch_of()

    id_type = texts.schema["doc_id"].dataType.simpleString()
    return texts.mapInArrow(rows, ", ".join(f"{n} {t}" for n, t in INDEX_COLUMNS.items()).format(id_type=id_type))


INDEX_COLUMNS = {
    "shard": "string",
    "docs": "bigint",
    "words": "bigint",
    "ids": "array<{id_type}>",
    "lengths": "binary",
    "vocabulary": "binary",
    "starts": "binary",
    "places": "binary",
    "counts": "binary",
}


def document_frequencies(index: DataFrame) -> DataFrame:
    """(term, df): the documents that hold each term."""

    def rows(batches):
        import pyarrow as pa

        for batch in batches:
            for vocabulary, starts in zip(cells(batch, "vocabulary"), cells(batch, "starts"), strict=True):
                df = np.diff(np.frombuffer(starts, np.int64))
                yield pa.RecordBatch.from_pydict(
                    {"term": pa.array(vocabulary.split(b" "), pa.binary()), "df": pa.array(df, pa.int64())}
                )

    counted = index.select("vocabulary", "starts").mapInArrow(rows, "term binary, df bigint")
    return counted.groupBy("term").agg(F.sum("df").alias("df"))


def item_terms(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(item, item_id, term) for each different term of each row of `items`; item is the row's key."""
    texts = texts_of(items, id_col, text_col)

    def rows(batches):
        import pyarrow as pa

        for batch in batches:
            at, terms = [], []
            for i, body in enumerate(cells(batch, "body")):
                found = sorted({word for words in terms_of(body) for word in words})
                at += [i] * len(found)
                terms += found
            at = pa.array(at, pa.int64())
            yield pa.RecordBatch.from_pydict(
                {
                    "item": field(batch, "row_key").take(at),
                    "item_id": field(batch, "doc_id").take(at),
                    "term": pa.array(terms, pa.binary()),
                }
            )

    id_type = texts.schema["doc_id"].dataType.simpleString()
    return texts.mapInArrow(rows, f"item string, item_id {id_type}, term binary")


class List(NamedTuple):
    """A term's places in a shard, what each is worth, the largest and the tenth largest worth."""

    places: np.ndarray
    impacts: np.ndarray
    top: int
    tenth: int


class Lists:
    """The lists of one shard, with what each document's place in them is worth."""

    def __init__(self, row: dict, n_docs: int, n_words: int):
        lengths = np.frombuffer(row["lengths"], np.int64)
        self.docs = len(lengths)
        self.m = 100 - 90 + (90 * lengths * n_docs) // n_words
        self.number = {term: i for i, term in enumerate(row["vocabulary"].split(b" "))}
        self.starts = np.frombuffer(row["starts"], np.int64)
        self.places = np.frombuffer(row["places"], np.int32)
        self.counts = np.frombuffer(row["counts"], np.int32)
        self.scratch = np.zeros(self.docs, np.int64)
        self.terms: dict[bytes, List | None] = {}
        self.pairs: dict[tuple[bytes, bytes], Unit] = {}

    def list_of(self, term: bytes, weight: int) -> List | None:
        """The list of a term, or None if no document holds it."""
        if term not in self.terms:
            number, found = self.number.get(term), None
            if number is not None:
                part = slice(*self.starts[number : number + 2])
                places, tf = self.places[part], self.counts[part].astype(np.int64)
                impacts = weight * ((1000000000 * tf) // (1000 * tf + 8 * self.m[places]))
                found = List(places, impacts, int(impacts.max()), tenth_best(impacts))
            self.terms[term] = found
        return self.terms[term]

    def pair(self, one: tuple[bytes, int], other: tuple[bytes, int]) -> Unit | None:
        """The two terms' lists with their intersection's joint maximum, built once for all items."""
        key = one[0], other[0]
        if key not in self.pairs:
            lists = [x for x in (self.list_of(*one), self.list_of(*other)) if x is not None]
            self.pairs[key] = Unit(lists, self.intersection(*lists) if len(lists) == 2 else None)
        return self.pairs[key] if self.pairs[key].lists else None


    def intersection(self, one: List, other: List) -> np.ndarray:
        """The joint impacts of the documents that are in both lists."""
        self.scratch[one.places] = one.impacts
        first = self.scratch[other.places]
        self.scratch[one.places] = 0
        both = first > 0
        return first[both] + other.impacts[both]


class Unit:
    """One term's list, or two with the joint impacts of their intersection: the bound of what a document
    gets from it."""

    def __init__(self, lists: list[List], joint: np.ndarray | None = None):
        self.lists = lists
        self.apart = sum(x.top for x in lists)
        self.bound = max((x.top for x in lists), default=0)
        # Ten documents get at least this much: the tenth best of a list or of the intersection.
        self.floor = max((x.tenth for x in lists), default=0)
        if joint is not None and len(joint):
            self.bound = max(self.bound, int(joint.max()))
            self.floor = max(self.floor, tenth_best(joint))


def tenth_best(scores: np.ndarray) -> int:
    return int(np.partition(scores, -BEST)[-BEST]) if len(scores) >= BEST else 0


def in_pairs(terms: list[tuple[bytes, int]]) -> list[tuple[tuple[bytes, int], ...]]:
    """An item's (term, weight) as pairs of neighbours by falling weight; an odd one stays alone."""
    ranked = sorted(terms, key=lambda t: (-t[1], t[0]))
    return [tuple(ranked[i : i + 2]) for i in range(0, len(ranked), 2)]


def best_in_shard(lists: Lists, terms: list[tuple[bytes, int]], pair_bounds: bool = True) -> tuple[np.ndarray, np.ndarray, int]:
    """Places and scores of the ten best documents of a shard, and how many postings were added up.

    `pair_bounds` off uses the sums of the terms' own maxima instead, to compare.
    """
    units = []
    for group in in_pairs(terms):
        if len(group) == 2:
            unit = lists.pair(*group)
        else:
            alone = lists.list_of(*group[0])
            unit = Unit([alone]) if alone is not None else None
        if unit is not None:
            units.append(unit)
    if not units:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), 0
    bound_of = (lambda u: u.bound) if pair_bounds else (lambda u: u.apart)
    units.sort(key=bound_of, reverse=True)
    # What documents get at most from the units that are left.
    rest = np.cumsum([0, *map(bound_of, reversed(units))])[::-1]
    scores, goal, read = np.zeros(lists.docs, np.int64), max(u.floor for u in units), 0
    goal = max(goal, 1)
    step = 0
    while step < len(units) and rest[step] >= goal:
        for found in units[step].lists:
            scores[found.places] += found.impacts
            read += len(found.places)
        goal = max(goal, tenth_best(scores))
        step += 1
    kept = np.flatnonzero((scores > 0) & (scores + rest[step] >= goal))
    for number in range(step, len(units)):
        for found in units[number].lists:
            at = np.searchsorted(found.places, kept)
            at[at == len(found.places)] = 0
            hit = found.places[at] == kept
            scores[kept[hit]] += found.impacts[at[hit]]
            read += int(hit.sum())
        goal = max(goal, tenth_best(scores[kept]))
        kept = kept[scores[kept] + rest[number + 1] >= goal]
    kept = kept[scores[kept] > 0]
    order = np.lexsort((kept, -scores[kept]))[:BEST]
    return kept[order], scores[kept[order]], read


def search(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    shard_bytes: int = SHARD_BYTES,
    block_terms: int = BLOCK_TERMS,
) -> DataFrame:
    """item (the row's key), item_id, rank, doc_id and score: the ten best documents of each row of `items`.

    Missing and empty texts have no terms: such documents are not found and not counted, such items get
    no rows. Rows that repeat are documents, or items, of their own; of equal scores the lower id comes
    first, a missing id last. Empty tables give no rows; other columns are not looked at.
    """
    spark = docs.sparkSession
    folder = shared_folder(spark)
    build_index(docs, id_col, text_col, shard_bytes).write.parquet(f"{folder}/index")
    index = spark.read.parquet(f"{folder}/index")
    shards, n_docs, n_words = index.agg(F.count("*"), F.sum("docs"), F.sum("words")).first()

    wanted = item_terms(items, item_col, item_text_col)
    weight = F.floor(1000 * F.log((F.lit(2.0) * (n_docs or 0) + 2) / (2 * F.col("df") + 1))).cast("bigint")
    weighted = wanted.join(document_frequencies(index), "term").withColumn("weight", weight)
    weighted.where("weight > 0").write.parquet(f"{folder}/terms")
    weighted = spark.read.parquet(f"{folder}/terms")
    blocks = max(1, -(-weighted.count() // block_terms))

    by_item = weighted.groupBy("item", "item_id").agg(
        F.collect_list(F.struct("term", "weight")).alias("terms")
    )
    groups = max(1, shards)
    copies = by_item.select(
        "item", "item_id", "terms", F.pmod(F.xxhash64("item"), F.lit(blocks)).alias("block"),
        F.explode(F.expr(f"sequence(0L, {groups - 1}L)")).alias("group"),
    )
    visited = index.select(
        "*", F.explode(F.expr(f"sequence(0L, {blocks - 1}L)")).alias("block"),
        F.pmod(F.xxhash64("shard"), F.lit(groups)).alias("group"),
    )

    def visit(here, asked):
        import pyarrow as pa

        asked = asked.combine_chunks()
        items_here = [
            [(t["term"], t["weight"]) for t in terms] for terms in asked["terms"].to_pylist()
        ]
        at, found_ids, found_scores = [], [], []
        for number in range(here.num_rows if items_here else 0):
            row = {name: here[name][number].as_py() for name in ("lengths", "vocabulary", "starts", "places", "counts")}
            lists, ids = Lists(row, n_docs, n_words), here["ids"][number].values
            # The intersections of all pairs of these items, before any item is ranked.
            for terms in items_here:
                for group in in_pairs(terms):
                    if len(group) == 2:
                        lists.pair(*group)
            for i, terms in enumerate(items_here):
                places, scores, _ = best_in_shard(lists, terms)
                at += [i] * len(places)
                found_ids.append(ids.take(pa.array(places)))
                found_scores += scores.tolist()
        rows = pa.array(at, pa.int64())
        ids = pa.concat_arrays(found_ids) if found_ids else pa.array([], doc_arrow)
        return pa.table(
            {
                "item": asked["item"].take(rows).cast(pa.string()),
                "item_id": asked["item_id"].take(rows).cast(item_arrow),
                "doc_id": ids.cast(doc_arrow),
                "score": pa.array(found_scores, pa.int64()),
            }
        )

    from pyspark.sql.pandas.types import to_arrow_type

    # Strings may come with wide offsets, but go back with narrow ones.
    item_arrow = to_arrow_type(items.schema[item_col].dataType)
    doc_arrow = to_arrow_type(docs.schema[id_col].dataType)
    item_type = items.schema[item_col].dataType.simpleString()
    id_type = docs.schema[id_col].dataType.simpleString()
    found = (
        visited.groupBy("group", "block").cogroup(copies.groupBy("group", "block"))
        .applyInArrow(visit, f"item string, item_id {item_type}, doc_id {id_type}, score bigint")
    )
    best = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= BEST)
    return ranked.select("item", "item_id", "rank", "doc_id", "score")
