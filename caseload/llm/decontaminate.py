"""Benchmark decontamination with suffix arrays of the training text.

Each task takes its documents in shards of a bounded size. Words get the number that they have in the
benchmark's vocabulary; a word that no item has breaks every match, so only runs of known words that
are long enough for the shortest window go into the shard's suffix array, which is sorted by doubling.
Every suffix of the test items is binary-searched in it, all of them at once: the range that shares a
whole window with it gives the places where the window occurs, and the neighbours of its place give the
longest verbatim match there. Nothing is shuffled, and a frequent passage is marked where it is.

The items go to the tasks in broadcast blocks of a checked size. A larger benchmark has several blocks,
each searched by a pass of its own, and their marks are united by document.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .rows import column, field, numbered, row_key, slices

#: Words of a window.
WINDOW = 10
#: Bytes of text in a suffix array, and bytes of items in a broadcast block.
SHARD_BYTES = 8 << 20
BLOCK_BYTES = 16 << 20

#: Byte classes: words are [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ after A-Z became a-z.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
WORD = np.zeros(256, bool)
WORD[48:58] = WORD[97:123] = WORD[128:] = True


def word_bounds(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where words start and end in lower-cased bytes of texts that end at `ends`."""
    word = np.zeros(len(data) + 1, bool)
    word[:-1] = WORD[data]
    before = np.r_[False, word[:-1]]
    # Texts lie side by side: a word ends where its text ends.
    cuts = ends[ends < len(data)]
    starts = word & ~before
    starts[cuts] |= word[cuts]
    stops = ~word & before
    stops[cuts] |= before[cuts]
    return np.flatnonzero(starts), np.flatnonzero(stops)


def word_parts(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray, part: int) -> np.ndarray:
    """Bytes 8 part to 8 part + 8 of each word as one number; bytes after its end are zero.

    `data` has eight bytes more than its texts.
    """
    at = starts + 8 * part
    low = at >> 3
    words = data.view("<u8")
    shift = ((at & 7) << 3).astype(np.uint64)
    value = words[low] >> shift
    high = words[low + 1] << ((np.uint64(64) - shift) & np.uint64(63))
    value |= np.where(shift > 0, high, np.uint64(0))
    rest = np.clip(lengths - 8 * part, 0, 8)
    return value & MASKS[rest]


MASKS = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)
MIXERS = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def padded(data: np.ndarray) -> np.ndarray:
    """Lower-cased bytes with zeros behind, a whole number of eights."""
    out = np.zeros((len(data) + 31) // 8 * 8, np.uint8)
    out[: len(data)] = LOWER[data]
    return out


def word_keys(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """A 64-bit key of each word; equal words have equal keys, and equal keys are compared later."""
    keys = lengths.astype(np.uint64) * MIXERS[1]
    todo, part = np.arange(len(starts)), 0
    while len(todo):
        mixed = (keys[todo] ^ word_parts(data, starts[todo], lengths[todo], part)) * MIXERS[0]
        keys[todo] = mixed ^ (mixed >> np.uint64(29))
        part += 1
        todo = todo[lengths[todo] > 8 * part]
    return keys


def suffix_ranks(text: np.ndarray, depth: int) -> np.ndarray:
    """The rank of each suffix by its first `depth` words at least; equal ones share a rank."""
    rank = np.unique(text, return_inverse=True)[1].astype(np.int64)
    step = 1
    while step < depth and len(rank) and rank.max() + 1 < len(rank):
        later = np.zeros(len(rank), np.int64)
        later[:-step] = rank[step:] + 1
        rank = np.unique(rank * (len(rank) + 2) + later, return_inverse=True)[1]
        step *= 2
    return rank


class Items:
    """The benchmark's items as numbers: vocabulary, test suffixes in order, windows and their items."""

    def __init__(self, items: list[tuple[str, bytes]], window: int):
        data = np.frombuffer(b"\n".join(text for _, text in items), np.uint8)
        sizes = np.array([len(text) for _, text in items], np.int64)
        ends = np.cumsum(sizes + 1) - 1
        self.data = padded(data)
        starts, stops = word_bounds(self.data[: len(data)], ends[:-1])
        lengths = stops - starts
        keys = word_keys(self.data, starts, lengths)
        # Words are equal when all their parts are; the key is only an order.
        parts = [keys, lengths.astype(np.uint64)]
        parts += [word_parts(self.data, starts, lengths, p) for p in range(-(-int(lengths.max(initial=0)) // 8))]
        order = np.lexsort(parts[::-1])
        new = np.zeros(len(order), bool)
        for part in parts:
            new[1:] |= part[order][1:] != part[order][:-1]
        number = np.empty(len(order), np.int64)
        number[order] = np.cumsum(new) + 1 if len(order) else number
        first = order[np.r_[True, new[1:]]] if len(order) else order
        self.keys, self.starts, self.lengths = keys[first], starts[first], lengths[first]
        self.longest = int(lengths.max(initial=0))
        self.known = np.zeros(1 << 20, bool)
        self.known[(self.keys >> np.uint64(44)).astype(np.int64)] = True
        item = np.searchsorted(ends, starts, side="right")
        # The items' words, a zero behind each item.
        self.words = np.zeros(len(starts) + len(items), np.int64)
        place = np.arange(len(starts)) + item
        self.words[place] = number
        count = np.bincount(item, minlength=len(items))
        size = np.minimum(window, count)[item]
        begins = np.cumsum(np.r_[0, count])[item]
        fits = np.arange(len(starts)) - begins + size <= count[item]
        self.depth = int(count.max(initial=1))
        rank = suffix_ranks(self.words, self.depth)[place] if len(place) else place
        self.sorted = place[np.argsort(rank, kind="stable")]
        # Distinct windows, and the items that have each.
        at, size, of = place[fits], size[fits], item[fits]
        grid = np.zeros((len(at), window + 1), np.int64)
        for j in range(window):
            inside = size > j
            grid[inside, j] = self.words[at[inside] + j]
        grid[:, window] = size
        _, first, which = np.unique(grid, axis=0, return_index=True, return_inverse=True)
        self.windows, self.sizes = at[first], size[first]
        self.shortest = int(self.sizes.min(initial=window))
        pairs = np.unique(np.stack([which.reshape(-1), of], axis=1), axis=0) if len(at) else np.zeros((0, 2), int)
        self.bounds = np.searchsorted(pairs[:, 0], np.arange(len(first) + 1))
        self.owners = pairs[:, 1]
        self.ids = [i for i, _ in items]

    def numbers(self, data: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
        """The vocabulary's number of each word of a text, 0 for a word that no item has."""
        found = np.zeros(len(starts), np.int64)
        lengths = stops - starts
        todo = np.flatnonzero(lengths <= self.longest)
        if not len(todo) or not len(self.keys):
            return found
        keys = word_keys(data, starts[todo], lengths[todo])
        likely = self.known[(keys >> np.uint64(44)).astype(np.int64)]
        todo, keys = todo[likely], keys[likely]
        # Equal keys of different words are next to each other, and each is compared.
        spot = np.searchsorted(self.keys, keys)
        while len(todo):
            inside = spot < len(self.keys)
            inside[inside] = self.keys[spot[inside]] == keys[inside]
            todo, keys, spot = todo[inside], keys[inside], spot[inside]
            same = self.lengths[spot] == lengths[todo]
            part = 0
            while part * 8 < self.longest:
                open_ = np.flatnonzero(same & (lengths[todo] > 8 * part))
                if not len(open_):
                    break
                ours = word_parts(data, starts[todo[open_]], lengths[todo[open_]], part)
                theirs = word_parts(self.data, self.starts[spot[open_]], self.lengths[spot[open_]], part)
                same[open_] = ours == theirs
                part += 1
            found[todo[same]] = spot[same] + 1
            todo, keys, spot = todo[~same], keys[~same], spot[~same] + 1
        return found


def compare(text, at, words, query, size) -> np.ndarray:
    """-1, 0 or 1: how suffixes of `text` compare with the first `size` words of suffixes of `words`."""
    out = np.zeros(len(at), np.int64)
    todo, j = np.arange(len(at)), 0
    while len(todo):
        todo = todo[size[todo] > j]
        a = text[np.minimum(at[todo] + j, len(text) - 1)]
        b = words[query[todo] + j]
        out[todo] = np.sign(a - b)
        todo = todo[(a == b) & (a > 0)]
        j += 1
    return out


def search(text, order, words, query, size, after: bool) -> np.ndarray:
    """For each query the number of suffixes in `order` that are before it (and equal to it if `after`)."""
    low, high = np.zeros(len(query), np.int64), np.full(len(query), len(order))
    while (open_ := low < high).any():
        q = np.flatnonzero(open_)
        middle = (low[q] + high[q]) >> 1
        sign = compare(text, order[middle], words, query[q], size[q])
        right = sign <= 0 if after else sign < 0
        low[q[right]] = middle[right] + 1
        high[q[~right]] = middle[~right]
    return low


def common(text, at, words, query) -> np.ndarray:
    """The number of words that suffixes share from their first."""
    n = np.zeros(len(at), np.int64)
    todo = np.arange(len(at))
    while len(todo):
        a = text[np.minimum(at[todo] + n[todo], len(text) - 1)]
        b = words[np.minimum(query[todo] + n[todo], len(words) - 1)]
        todo = todo[(a == b) & (a > 0)]
        n[todo] += 1
    return n


def find_matches(items: Items, data: np.ndarray, ends: np.ndarray):
    """Per text: number of words, and of the texts with a match: hit words, longest match, item numbers.

    Gives (n_words, {text: (spans, longest, items)}); spans are [from, to) in words of the text.
    """
    body = padded(data)
    starts, stops = word_bounds(body[: len(data)], ends[:-1])
    text_of = np.searchsorted(ends, starts, side="right")
    n_words = np.bincount(text_of, minlength=len(ends))
    first_word = np.cumsum(np.r_[0, n_words])
    if not len(items.windows) or not len(starts):
        return n_words, {}
    numbers = items.numbers(body, starts, stops)
    # Runs of known words of one text that can hold the shortest window.
    breaks = (numbers == 0) | np.r_[True, text_of[1:] != text_of[:-1]]
    run = np.cumsum(breaks)
    known = numbers > 0
    long_enough = known & (np.bincount(run, weights=known)[run] >= items.shortest)
    kept = np.flatnonzero(long_enough)
    if not len(kept):
        return n_words, {}
    gaps = np.cumsum(np.r_[False, run[kept][1:] != run[kept][:-1]])
    where = np.arange(len(kept)) + gaps
    text = np.zeros(where[-1] + 2, np.int64)
    text[where] = numbers[kept]
    word_at = np.full(len(text), -1)
    word_at[where] = kept
    # The suffix array: places in order of their suffixes.
    rank = suffix_ranks(text, items.depth)
    order = where[np.argsort(rank[where], kind="stable")]
    low = search(text, order, items.words, items.windows, items.sizes, after=False)
    high = search(text, order, items.words, items.windows, items.sizes, after=True)
    n = high - low
    window = np.repeat(np.arange(len(n)), n)
    at = order[np.repeat(low - np.r_[0, np.cumsum(n)[:-1]], n) + np.arange(n.sum())]
    if not len(at):
        return n_words, {}
    # Longest matches: the test suffixes on either side of a place in the common order.
    place = np.unique(at)
    every = np.full(len(items.sorted), items.depth)
    before = search(text, order, items.words, items.sorted, every, after=False)
    spot = np.empty(len(text), np.int64)
    spot[order] = np.arange(len(order))
    beside = np.searchsorted(before, spot[place], side="right")
    longest = np.zeros(len(place), np.int64)
    for side in (np.maximum(beside - 1, 0), np.minimum(beside, len(items.sorted) - 1)):
        longest = np.maximum(longest, common(text, place, items.words, items.sorted[side]))
    word = word_at[at]
    owner = text_of[word]
    hits = np.zeros(len(starts) + 1, np.int64)
    np.add.at(hits, word, 1)
    np.add.at(hits, word + items.sizes[window], -1)
    hit = np.cumsum(hits[:-1]) > 0
    edge = np.r_[True, text_of[1:] != text_of[:-1]]
    begin = np.flatnonzero(hit & (edge | ~np.r_[False, hit[:-1]]))
    finish = np.flatnonzero(hit & np.r_[edge[1:] | ~hit[1:], True]) + 1
    found = {}
    longest_of = np.zeros(len(ends), np.int64)
    np.maximum.at(longest_of, text_of[word_at[place]], longest)
    for t in np.unique(owner):
        x, y = np.searchsorted(begin, [first_word[t], first_word[t + 1]])
        found[int(t)] = [np.stack([begin[x:y], finish[x:y]], axis=1) - first_word[t], int(longest_of[t]), None]
    pairs = np.unique(np.stack([owner, window], axis=1), axis=0)
    cuts = np.flatnonzero(np.r_[True, pairs[1:, 0] != pairs[:-1, 0], True])
    for x, y in zip(cuts[:-1], cuts[1:], strict=True):
        owners = [items.owners[items.bounds[w] : items.bounds[w + 1]] for w in pairs[x:y, 1]]
        found[int(pairs[x, 0])][2] = np.unique(np.concatenate(owners))
    return n_words, found


def item_blocks(items: DataFrame, id_col: str, text_col: str, block_bytes: int) -> list[DataFrame]:
    """The items in blocks of about `block_bytes`, by a hash of their text."""
    texts = items.select(
        F.coalesce(column(id_col).cast("string"), F.lit("")).alias("item_id"),
        F.coalesce(column(text_col).cast("string"), F.lit("")).cast("binary").alias("body"),
    )
    total = texts.agg(F.sum(F.octet_length("body") + 16)).first()[0] or 0
    blocks = max(1, -(-total // block_bytes))
    return [texts.where(F.pmod(F.xxhash64("item_id", "body"), F.lit(blocks)) == b) for b in range(blocks)]


def _searched(docs: DataFrame, text_name: str, block: DataFrame, window: int, emit, schema: str) -> DataFrame:
    """Search one block of items in all rows of `docs`; `emit` turns a piece's matches into batches."""
    built = Items(sorted((r["item_id"], bytes(r["body"])) for r in block.collect()), window)
    # Arrays and lists alone: the class goes with the function.
    items = block.sparkSession.sparkContext.broadcast(vars(built))

    def rows(batches):
        import pyarrow as pa

        known = Items.__new__(Items)
        vars(known).update(items.value)
        for batch in slices(batches, text_name, SHARD_BYTES):
            texts = field(batch, text_name)
            width = np.int64 if pa.types.is_large_binary(texts.type) or pa.types.is_large_string(texts.type) else np.int32
            offsets = np.frombuffer(texts.buffers()[1], width)[texts.offset : texts.offset + len(texts) + 1]
            data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
            ends = (offsets[1:] - offsets[0]).astype(np.int64)
            yield from emit(known, batch, *find_matches(known, data, ends))

    return docs.mapInArrow(rows, schema)


def contamination(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    window: int = WINDOW,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """One row per row of `docs`: doc_id, n_words, n_hit, n_items, items_sha256, contaminated, and the
    locations: spans of hit words, the length of the longest verbatim match, and the items.

    Missing texts have no words; items without words have no windows. Items with one id count once.
    A missing item id is an empty one. Empty tables give no rows, or no hits.
    """
    id_type = docs.schema[id_col].dataType.simpleString()
    texts = docs.select(
        row_key(docs).alias("row_key"),
        column(id_col).alias("doc_id"),
        F.coalesce(column(text_col).cast("string"), F.lit("")).cast("binary").alias("body"),
    )
    spans = "array<struct<from: bigint, to: bigint>>"
    schema = f"row_key string, doc_id {id_type}, n_words bigint, spans {spans}, longest bigint, item_ids array<string>"

    def emit(known, batch, n_words, found):
        import pyarrow as pa

        none = (np.zeros((0, 2), np.int64), 0, ())
        each = [found.get(i, none) for i in range(len(n_words))]
        yield pa.RecordBatch.from_pydict(
            {
                "row_key": field(batch, "row_key"),
                "doc_id": field(batch, "doc_id"),
                "n_words": pa.array(n_words.astype(np.int64)),
                "spans": pa.array(
                    [[{"from": int(x), "to": int(y)} for x, y in e[0]] for e in each],
                    pa.list_(pa.struct([("from", pa.int64()), ("to", pa.int64())])),
                ),
                "longest": pa.array([e[1] for e in each], pa.int64()),
                "item_ids": pa.array([[known.ids[i] for i in e[2]] for e in each], pa.list_(pa.string())),
            }
        )

    parts = [
        _searched(texts, "body", block, window, emit, schema)
        for block in item_blocks(items, item_id_col, text_col, block_bytes)
    ]
    found = parts[0]
    if len(parts) > 1:
        for part in parts[1:]:
            found = found.unionByName(part)
        found = found.groupBy("row_key").agg(
            F.first("doc_id").alias("doc_id"),
            F.first("n_words").alias("n_words"),
            F.array_sort(F.flatten(F.collect_list("spans"))).alias("spans"),
            F.max("longest").alias("longest"),
            F.flatten(F.collect_list("item_ids")).alias("item_ids"),
        )
        # United spans: each part counts what lies behind all before it.
        start = F.struct(F.lit(0).cast("bigint").alias("end"), F.lit(0).cast("bigint").alias("n"))
        n_hit = F.aggregate(
            "spans",
            start,
            lambda a, s: F.struct(
                F.greatest(a["end"], s["to"]).alias("end"),
                (a["n"] + F.greatest(F.lit(0), s["to"] - F.greatest(a["end"], s["from"]))).alias("n"),
            ),
            lambda a: a["n"],
        )
    else:
        n_hit = F.aggregate("spans", F.lit(0).cast("bigint"), lambda a, s: a + s["to"] - s["from"])
    distinct = F.array_sort(F.array_distinct("item_ids"))
    return found.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size(distinct).cast("bigint").alias("n_items"),
        F.sha2(F.array_join(distinct, ",").cast("binary"), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"),
        "spans",
        "longest",
        distinct.alias("item_ids"),
    )


def drop_contaminated(
    docs: DataFrame,
    items: DataFrame,
    text_col: str = "text",
    item_id_col: str = "item_id",
    window: int = WINDOW,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """The rows of `docs` in which no window of any item occurs, with all their columns.

    The rows are filtered where they are searched: once per block of items, without a shuffle.
    """
    kept, name = numbered(docs, text_col)

    def emit(known, batch, n_words, found):
        import pyarrow as pa

        clean = np.ones(len(n_words), bool)
        clean[list(found)] = False
        yield batch.filter(pa.array(clean))

    for block in item_blocks(items, item_id_col, text_col, block_bytes):
        kept = _searched(kept, name, block, window, emit, kept.schema)
    return kept.select(kept.columns[: len(docs.columns)]).toDF(*docs.columns)
