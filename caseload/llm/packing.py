"""Best-fit packing of tokenised documents into sequences, by a grouping genetic algorithm on islands.

Every document becomes token ids; one longer than a sequence is cut, its first piece taking what is
left over. Full pieces are sequences of their own. The others are dealt by a hash into cells of about
CELL pieces, and each cell is one packing problem, evolved on several islands at once: a solution is a
list of groups (bins), crossover injects whole well-filled bins of one parent into the other, drops the
bins that hold one of their pieces already, and puts displaced pieces back by best fit, largest first.
After each epoch the best solution of an island moves to the next one. A cell that reaches its lower
bound stops. Only a cell's lengths travel between islands, never the documents.

A token id is the byte-level BPE's. A text is cut before every blank that another character follows: there
the tokenizer always starts a new word, so pieces can be encoded alone and remembered.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .rows import cells, field, freeze, texts_of

SEQUENCE = 1024
#: Id after each document.
END = 2
#: Pieces of a packing problem, islands that work on it, and rounds between migrations.
CELL = 4096
ISLANDS = 3
EPOCHS = 2
POPULATION = 5
GENERATIONS = 5
#: Remembered words; longer ones than WORD characters are not kept.
MEMORY = 300_000
WORD = 64
#: The tokenizer's one special token, which its library finds anywhere in a text.
SPECIAL = "<|endoftext|>"


class Encoder:
    """Token ids of texts as little-endian unsigned 32-bit numbers, as `tokenizers` gives them.

    Words of Latin letters are encoded by `tiktoken` from the same vocabulary, about four times
    faster; the two libraries may class rarer characters differently, so those and texts with the
    special token go to `tokenizers`.
    """

    def __init__(self, vocabulary: str | None = None, ranks: str | None = None):
        import base64
        import re

        import public_tokenizers
        import tiktoken

        self.vocabulary = vocabulary or public_tokenizers.path("byte_bpe_50k.json")
        with open(ranks or public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as lines:
            merges = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.latin = tiktoken.Encoding(
            "latin", pat_str=public_tokenizers.PATTERN, mergeable_ranks=merges, special_tokens={}
        )
        self.exact = None
        self.rare = re.compile("[^\x00-ɏ]")
        self.gap = re.compile(r" (?=\s|\Z)")
        self.cut = re.compile(r" (?=\S)")
        self.memory: dict[str, bytes] = {}

    def tokens(self, text: str) -> bytes:
        if self.rare.search(text) is None and SPECIAL not in text:
            return np.array(self.latin.encode_ordinary(text), "<u4").tobytes()
        if self.exact is None:
            from tokenizers import Tokenizer

            self.exact = Tokenizer.from_file(self.vocabulary)
        return np.array(self.exact.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def document(self, text: str) -> bytes:
        """All ids of a text, without the end."""
        if SPECIAL in text:
            return self.tokens(text)
        words = text.split(" ") if self.gap.search(text) is None else self.cut.split(text)
        memory = self.memory
        found = [self.tokens(words[0])]
        found += map(memory.get, words[1:])
        if None in found:
            if len(memory) > MEMORY:
                memory.clear()
            for i, ids in enumerate(found):
                if ids is None:
                    word = words[i]
                    found[i] = ids = memory.get(word) or self.tokens(" " + word)
                    if len(word) <= WORD:
                        memory[word] = ids
        return b"".join(found)


def piece_lengths(total: int, most: int) -> list[int]:
    """A document's pieces: all full but the first."""
    pieces = -(-total // most)
    return [total - most * (pieces - 1)] + [most] * (pieces - 1)


def pieces_of(docs: DataFrame, id_col: str, text_col: str, most: int) -> DataFrame:
    """row_key, doc_id, piece, start, length and ids_crc32 of every piece of every row."""
    texts = texts_of(docs, id_col, text_col)

    def rows(batches):
        import zlib

        import pyarrow as pa

        encoder, end = Encoder(), np.array([END], "<u4").tobytes()
        for batch in batches:
            row, piece, start, length, crc = [], [], [], [], []
            for i, body in enumerate(cells(batch, "body")):
                ids = encoder.document(body.decode("utf-8", "replace")) + end
                place = 0
                for number, n in enumerate(piece_lengths(len(ids) // 4, most)):
                    row.append(i)
                    piece.append(number)
                    start.append(place)
                    length.append(n)
                    crc.append(zlib.crc32(ids[4 * place : 4 * (place + n)]))
                    place += n
            row = pa.array(row, pa.int64())
            yield pa.RecordBatch.from_pydict(
                {
                    "row_key": field(batch, "row_key").take(row),
                    "doc_id": field(batch, "doc_id").take(row),
                    "piece": pa.array(piece, pa.int32()),
                    "start": pa.array(start, pa.int64()),
                    "length": pa.array(length, pa.int64()),
                    "ids_crc32": pa.array(crc, pa.int64()),
                }
            )

    id_type = texts.schema["doc_id"].dataType.simpleString()
    return texts.mapInArrow(
        rows, f"row_key string, doc_id {id_type}, piece int, start bigint, length bigint, ids_crc32 bigint"
    )


def best_fit(lengths: list[int], order: list[int], place: list[int], free: list[int], most: int) -> None:
    """Put the pieces in `order` each into the fullest bin that has room; `place` and `free` change.

    One bit per amount of free room tells which amounts some bin has.
    """
    having: dict[int, list[int]] = {}
    mask = 0
    for number, room in enumerate(free):
        if room:
            having.setdefault(room, []).append(number)
            mask |= 1 << room
    for item in order:
        size = lengths[item]
        above = mask >> size
        if above:
            room = (above & -above).bit_length() - 1 + size
            held = having[room]
            number = held.pop()
            if not held:
                mask &= ~(1 << room)
        else:
            number, room = len(free), most
            free.append(most)
        place[item] = number
        room -= size
        free[number] = room
        if room:
            if having.get(room):
                having[room].append(number)
            else:
                having[room] = [number]
                mask |= 1 << room


def worth(place: np.ndarray, lengths: np.ndarray, most: int) -> tuple[int, float]:
    """Smaller is better: the number of bins, then how evenly filled they are."""
    fill = np.bincount(place, weights=lengths)
    return len(fill), -float(((fill / most) ** 2).sum() / len(fill))


def crossed(one: np.ndarray, other: np.ndarray, lengths: np.ndarray, most: int, rng) -> np.ndarray:
    """`one` with some well-filled bins of `other` in it."""
    fill = np.bincount(other, weights=lengths)
    # Bins are drawn by how full they are; a full one about one time in three.
    injected = rng.random(len(fill)) < 0.35 * (fill / most) ** 16
    if not injected.any():
        injected[int(fill.argmax())] = True
    given = injected[other]
    broken = np.zeros(int(one.max()) + 1, bool)
    broken[one[given]] = True
    displaced = np.flatnonzero(broken[one] & ~given)
    # Displaced pieces and those of the worst bins left are put back together.
    rest = np.bincount(one, weights=lengths)
    loose = ~broken & (rest < np.quantile(rest, 0.1)) & (rng.random(len(rest)) < 0.5)
    displaced = np.union1d(displaced, np.flatnonzero(loose[one] & ~given))
    stay = ~given & ~(broken | loose)[one]
    place = np.empty(len(lengths), np.int64)
    kept, number = np.unique(one[stay], return_inverse=True)
    place[stay] = number
    taken, number = np.unique(other[given], return_inverse=True)
    place[given] = number + len(kept)
    bins = len(kept) + len(taken)
    settled = stay | given
    free = (most - np.bincount(place[settled], weights=lengths[settled], minlength=bins)).astype(int).tolist()
    out = place.tolist()
    # Items are in order of falling length.
    best_fit(lengths.tolist(), displaced.tolist(), out, free, most)
    return np.array(out)


def lower_bound(lengths: np.ndarray, most: int) -> int:
    """Bins that any packing needs: by total length, and by pieces too long to share a bin.

    For each t, pieces over most - t are alone with what is shorter than t; those over half and not
    over most - t need a bin each, and what they can't take of the middle ones needs more.
    """
    best = -(-int(lengths.sum()) // most)
    count = np.bincount(lengths, minlength=most + 1)
    total = np.cumsum(count * np.arange(most + 1))
    number = np.cumsum(count)
    half = most // 2
    for t in range(half + 1):
        alone = number[most] - number[most - t]
        large = number[most - t] - number[half]
        large_sum = total[most - t] - total[half]
        middle = total[half] - (total[t - 1] if t else 0)
        room = large * most - large_sum
        best = max(best, int(alone + large + max(0, -(-(middle - room) // most))))
    return best


def evolve(lengths: np.ndarray, immigrants: list[np.ndarray], most: int, seed: list[int]) -> np.ndarray:
    """The best solution of an island after one epoch: the bin of each piece."""
    rng = np.random.default_rng(seed)
    bound = lower_bound(lengths, most)
    sizes = lengths.tolist()
    population = list(immigrants)
    while len(population) < POPULATION:
        # The first is packed by falling length; the others by length with some noise.
        noise = 0 if not population else rng.uniform(0, 0.3)
        order = np.argsort(-lengths * (1 + noise * rng.random(len(lengths))), kind="stable")
        place, free = [0] * len(sizes), []
        best_fit(sizes, order.tolist(), place, free, most)
        population.append(np.array(place))
        if len(free) == bound:
            return population[-1]
    scored = sorted(((worth(p, lengths, most), i, p) for i, p in enumerate(population)), key=lambda x: x[:2])
    number = len(scored)
    for _ in range(GENERATIONS):
        if scored[0][0][0] <= bound:
            break
        for _ in range(POPULATION // 2):
            # Each parent is the better of two drawn at random.
            a, b = (min(rng.integers(0, len(scored), 2)) for _ in range(2))
            child = crossed(scored[a][2], scored[b][2], lengths, most, rng)
            scored.append((worth(child, lengths, most), number, child))
            number += 1
        scored = sorted(scored, key=lambda x: x[:2])[:POPULATION]
    return scored[0][2]


def pack_cells(cells: DataFrame, most: int) -> DataFrame:
    """(cell, rank, bin, offset): the place of each piece of a cell, by its rank in falling length.

    `cells` has cell, length and n, the pieces of that length.
    """
    state = "cell bigint, island int, lengths array<int>, counts array<int>, bins array<int>"

    def epoch(number: int):
        def run(key, frame):
            import pandas as pd

            cell, island = (int(x.as_py() if hasattr(x, "as_py") else x) for x in key)
            if "length" in frame:
                frame = frame.sort_values("length", ascending=False)
                kinds, counts, elites = frame["length"].to_numpy(), frame["n"].to_numpy(), []
            else:
                kinds, counts = (np.array(frame[c].iloc[0]) for c in ("lengths", "counts"))
                elites = [np.array(b) for b in frame["bins"]]
            best = evolve(np.repeat(kinds, counts), elites, most, [number, cell, island])
            row = {"cell": cell, "island": island, "lengths": kinds.tolist(), "counts": counts.tolist()}
            return pd.DataFrame([{**row, "bins": best.tolist()}])

        return run

    islands = cells.withColumn("island", F.explode(F.array(*map(F.lit, range(ISLANDS)))))
    elites = islands.groupBy("cell", "island").applyInPandas(epoch(0), state)
    for number in range(1, EPOCHS):
        elites = freeze(elites)
        moved = elites.withColumn("island", F.pmod(F.col("island") + 1, F.lit(ISLANDS)))
        elites = elites.unionByName(moved).groupBy("cell", "island").applyInPandas(epoch(number), state)

    def settled(key, frame):
        import pandas as pd

        lengths = np.repeat(np.array(frame["lengths"].iloc[0]), np.array(frame["counts"].iloc[0]))
        best = min((np.array(b) for b in frame["bins"]), key=lambda b: worth(b, lengths, most))
        order = np.argsort(best, kind="stable")
        ends = np.cumsum(lengths[order])
        first = np.r_[True, best[order][1:] != best[order][:-1]]
        base = (ends - lengths[order])[first][np.cumsum(first) - 1]
        offset = np.empty(len(best), np.int64)
        offset[order] = ends - lengths[order] - base
        return pd.DataFrame({"cell": frame["cell"].iloc[0], "rank": np.arange(len(best)), "bin": best, "offset": offset})

    return elites.groupBy("cell").applyInPandas(settled, "cell bigint, rank bigint, bin bigint, offset bigint")


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", most: int = SEQUENCE) -> DataFrame:
    """One row per piece of every row of `docs`: row_key, doc_id, piece, start, length, ids_crc32,
    sequence_id and offset.

    A missing or empty text is the end id alone. Rows repeat as often as they are there, with ids
    missing or repeated. An empty table gives no rows; other columns are not looked at.
    """
    from pyspark.sql import Window

    pieces = freeze(pieces_of(docs, id_col, text_col, most))
    short = pieces.where(F.col("length") < most)
    cells = max(1, -(-short.count() // CELL))
    # The column is computed before it is a key, so that both reads deal alike.
    short = short.withColumn("cell", F.pmod(F.xxhash64("row_key", "piece"), F.lit(cells)))
    packed = pack_cells(short.groupBy("cell", "length").agg(F.count("*").alias("n")), most)
    order = Window.partitionBy("cell").orderBy(F.desc("length"), "row_key", "piece")
    ranked = short.withColumn("rank", (F.row_number().over(order) - 1).cast("bigint"))
    placed = ranked.join(packed, ["cell", "rank"]).withColumn(
        "sequence_id", (F.col("cell") * F.lit(1 << 31) + F.col("bin")) * 2
    )
    full = pieces.where(F.col("length") == most)
    full = full.withColumns(
        {"sequence_id": F.monotonically_increasing_id() * 2 + 1, "offset": F.lit(0).cast("bigint")}
    )
    columns = ["row_key", "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    return placed.select(columns).unionByName(full.select(columns))
