"""Byte-level BPE, encoding and decoding, by speculation and verification.

A word is first cut greedily, always by the longest token that fits. A sequence of tokens is what exact
merging gives if, and only if, each token is what its own bytes merge to and no merge crosses the border
of any two neighbours before both are whole. That is checked for all neighbours of a batch of words at
once, on arrays; only words with a failing pair are merged exactly, byte by byte.

Texts are cut before every blank that another character follows: there the pre-tokenizer always starts a
new word, so pieces can be encoded alone and remembered.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .rows import cells, field, slices, texts_of

VOCABULARY = "byte_bpe_50k.json"
#: Remembered pieces and words; they are forgotten after the window in which there are more.
MEMORY = 400_000
#: Words of up to so many bytes are merged together; longer ones alone, with a queue.
STEPS = (6, 9, 12, 16, 24, 48)
#: A text is encoded in windows of about so many characters, and a batch in slices of so many bytes.
WINDOW = 1 << 20
SLICE = 1 << 22
#: Letters before this one are classed alike everywhere; other texts are cut by the library itself.
RARE = "ɐ"
NEVER = np.iinfo(np.int64).max


def byte_letters() -> dict[str, int]:
    """The character that stands for each byte in vocabulary files: printable ones for themselves, the
    others in their order from U+0100 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    others = [b for b in range(256) if b not in set(plain)]
    return {**{chr(b): b for b in plain}, **{chr(256 + i): b for i, b in enumerate(others)}}


class ByteBPE:
    """Token ids of texts, and texts of token ids, as the `tokenizers` library gives them."""

    def __init__(self, vocabulary: str | None = None):
        import json

        import public_tokenizers
        import regex

        self.path = vocabulary or public_tokenizers.path(VOCABULARY)
        with open(self.path, encoding="utf-8") as file:
            described = json.load(file)
        letters = byte_letters()
        names = described["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in described["added_tokens"]}
        self.tokens: dict[int, bytes] = {i: bytes(map(letters.__getitem__, name)) for name, i in names.items()}
        self.tokens.update((i, content.encode()) for content, i in self.special.items())
        # One id more stands for nothing, beside which nothing merges.
        size = max(self.tokens) + 2
        self.byte_ids = np.zeros(256, np.int64)
        for letter, byte in letters.items():
            self.byte_ids[byte] = names[letter]

        # The merge that makes a token: its rank and both parts; a byte has rank -1.
        self.rank = np.full(size, -1, np.int64)
        self.left = np.zeros(size, np.int64)
        self.right = np.zeros(size, np.int64)
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, (a, b) in enumerate(described["model"]["merges"]):
            made = names[a + b]
            pair = names[a], names[b]
            self.merges[pair] = rank, made
            if self.rank[made] < 0:
                self.rank[made], self.left[made], self.right[made] = rank, *pair
        pairs = np.array([a * size + b for a, b in self.merges], np.int64)
        order = np.argsort(pairs)
        self.size, self.pairs = size, pairs[order]
        self.pair_rank = np.array([r for r, _ in self.merges.values()], np.int64)[order]
        self.made = np.array([m for _, m in self.merges.values()], np.int64)

        # Tokens that their own bytes merge to, and beginnings of such (without an id).
        self.known: dict[bytes, int] = {}
        whole = self._whole()
        for i in names.values():
            if whole[i]:
                token = self.tokens[i]
                for n in range(1, len(token)):
                    self.known.setdefault(token[:n], -1)
                self.known[token] = i
        self._grow_tree()
        self.memory = self._specials()
        self.words = regex.compile(public_tokenizers.PATTERN)
        self.rare = regex.compile(f"[{RARE}-\U0010ffff]")
        self.gap = regex.compile(r" (?=\s|\Z)")
        self.cut = regex.compile(r" (?=\S)")
        self.cutter = None

    def _grow_tree(self) -> None:
        """The known beginnings as a tree: node * 256 + byte leads to a node, and a node may be a token."""
        number = {b"": 0}
        for beginning in self.known:
            number[beginning] = len(number)
        self.node_token = np.array([-1, *self.known.values()], np.int64)
        edges = np.array([number[b[:-1]] * 256 + b[-1] for b in self.known], np.int64)
        order = np.argsort(edges)
        self.edges, self.edge_ends = edges[order], order + 1

    def _whole(self) -> np.ndarray:
        """Which tokens are what their own bytes merge to: both parts are, and nothing crosses the
        border between them before the merge that makes the token."""
        made = np.flatnonzero(self.rank >= 0)
        good = np.zeros(self.size, bool)
        good[self.byte_ids] = True
        fits = self.first_crossing(self.left[made], self.right[made]) == self.rank[made]
        for i, fit in sorted(zip(made.tolist(), fits.tolist(), strict=True), key=lambda x: self.rank[x[0]]):
            good[i] = fit and good[self.left[i]] and good[self.right[i]]
        return good

    def rank_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of the merge of each pair, NEVER if there is none."""
        key = left * self.size + right
        at = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
        return np.where(self.pairs[at] == key, self.pair_rank[at], NEVER)

    def first_crossing(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The lowest rank of a merge across the border of each pair of tokens, NEVER if none happens.

        The last part of the left token and the first one of the right are taken apart again, the later
        merge first. Of all parts that stood side by side, a pair's merge happens if its rank comes
        before the merges that took the two parts away; of equal ranks the one further left comes first.
        """
        found = np.full(len(left), NEVER, np.int64)
        at = np.arange(len(left))
        x, y = np.array(left, np.int64), np.array(right, np.int64)
        taken_x, taken_y = np.full(len(x), NEVER, np.int64), np.full(len(x), NEVER, np.int64)
        while len(at):
            across = self.rank_of(x, y)
            happens = (across < taken_x) & (across <= taken_y) & (across < NEVER)
            found[at[happens]] = np.minimum(found[at[happens]], across[happens])
            rank_x, rank_y = self.rank[x], self.rank[y]
            later = rank_x > rank_y
            taken_x, taken_y = np.where(later, rank_x, taken_x), np.where(later, taken_y, rank_y)
            go_on = np.maximum(rank_x, rank_y) >= 0
            x, y = np.where(later, self.right[x], x), np.where(later, y, self.left[y])
            at, x, y, taken_x, taken_y = (v[go_on] for v in (at, x, y, taken_x, taken_y))
        return found

    def propose(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """All words cut by the longest token that fits, from left to right: (word, token) in order.

        The words walk down the tree of tokens together, a byte at a time, and each time all of them have
        found their next token they start again behind it.
        """
        data = np.frombuffer(b"".join(words), np.uint8).astype(np.int64)
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)))
        place = np.concatenate([[0], ends[:-1]]).astype(np.int64)
        going, owners, found = np.flatnonzero(place < ends), [], []
        while len(going):
            at, stop = place[going], ends[going]
            token, behind = self.byte_ids[data[at]], at + 1
            live, node = np.arange(len(going)), np.zeros(len(going), np.int64)
            while len(live):
                key = node * 256 + data[at[live]]
                edge = np.minimum(np.searchsorted(self.edges, key), len(self.edges) - 1)
                fits = self.edges[edge] == key
                live, node = live[fits], self.edge_ends[edge[fits]]
                at[live] += 1
                whole = self.node_token[node]
                ends_here = whole >= 0
                token[live[ends_here]], behind[live[ends_here]] = whole[ends_here], at[live[ends_here]]
                inside = at[live] < stop[live]
                live, node = live[inside], node[inside]
            owners.append(going)
            found.append(token)
            place[going] = behind
            going = going[behind < stop]
        if not owners:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        owner, token = np.concatenate(owners), np.concatenate(found)
        order = np.argsort(owner, kind="stable")
        return owner[order], token[order]

    def merge(self, word: bytes) -> list[int]:
        """The exact ids: of all neighbours that merge, the lowest rank first, further left first."""
        import heapq

        ids = self.byte_ids[np.frombuffer(word, np.uint8)].tolist()
        after, before = [*range(1, len(ids)), -1], [*range(-1, len(ids) - 1)]
        queue = [
            (self.merges[pair][0], i, *pair)
            for i, pair in enumerate(zip(ids, ids[1:], strict=False))
            if pair in self.merges
        ]
        heapq.heapify(queue)
        while queue:
            _, i, a, b = heapq.heappop(queue)
            j = after[i]
            if ids[i] != a or j < 0 or ids[j] != b:
                continue
            ids[i], ids[j], after[i] = self.merges[a, b][1], -1, after[j]
            if after[j] >= 0:
                before[after[j]] = i
            for k in (before[i], i):
                if k >= 0 and after[k] >= 0:
                    pair = ids[k], ids[after[k]]
                    if pair in self.merges:
                        heapq.heappush(queue, (self.merges[pair][0], k, *pair))
        return [i for i in ids if i >= 0]

    def merge_together(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Words of about one length merged as `merge` does, a merge of each at a time: (word, token)."""
        nothing, width = self.size - 1, max(map(len, words))
        ids = np.full((len(words), width + 1), nothing)
        for i, word in enumerate(words):
            ids[i, : len(word)] = np.frombuffer(word, np.uint8)
        ids[:, :width] = np.where(ids[:, :width] < nothing, self.byte_ids[ids[:, :width] & 255], nothing)
        ranks = self.rank_of(ids[:, :-1], ids[:, 1:])
        going, owners, found, columns = np.arange(len(words)), [], [], np.arange(width)
        while len(going):
            at = ranks.argmin(1)
            rows = np.arange(len(going))
            first = ranks[rows, at]
            done = first == NEVER
            if done.any():
                row, column = np.nonzero(ids[done] != nothing)
                owners.append(going[done][row])
                found.append(ids[done][row, column])
                going, ids, ranks, at, first = (x[~done] for x in (going, ids, ranks, at, first))
                rows = np.arange(len(going))
            if not len(going):
                break
            # The merged part takes the first place, and all behind it move up.
            ids[rows, at] = self.made[first]
            behind = columns > at[:, None]
            ids[:, :width] = np.where(behind, ids[:, 1:], ids[:, :width])
            ids[:, width] = nothing
            ranks[:, :-1] = np.where(behind[:, :-1], ranks[:, 1:], ranks[:, :-1])
            ranks[:, -1] = NEVER
            ranks[rows, at] = self.rank_of(ids[rows, at], ids[rows, at + 1])
            before = np.flatnonzero(at)
            ranks[before, at[before] - 1] = self.rank_of(ids[before, at[before] - 1], ids[before, at[before]])
        owner, token = np.concatenate(owners), np.concatenate(found)
        order = np.argsort(owner, kind="stable")
        return owner[order], token[order]

    def _merge_all(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(word, token) of words merged exactly, those of like lengths together."""
        owners, found, start = [], [], 0
        order = sorted(range(len(words)), key=lambda i: len(words[i]))
        for most in (*STEPS, None):
            stop = start
            while stop < len(order) and (most is None or len(words[order[stop]]) <= most):
                stop += 1
            part = order[start:stop]
            if part and most is not None:
                owner, token = self.merge_together([words[i] for i in part])
                owners.append(np.array(part)[owner])
                found.append(token)
            elif part:
                for i in part:
                    ids = self.merge(words[i])
                    owners.append(np.full(len(ids), i))
                    found.append(np.array(ids, np.int64))
            start = stop
        return np.concatenate(owners), np.concatenate(found)

    def encode_words(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray, int]:
        """The ids of all words one after the other, where each word's begin and the last one's end, and
        how many words were merged exactly."""
        owner, token = self.propose(words)
        inside = np.flatnonzero(owner[1:] == owner[:-1])
        kinds, number = np.unique(token[inside] * self.size + token[inside + 1], return_inverse=True)
        bad = self.first_crossing(kinds // self.size, kinds % self.size) < NEVER
        failing = np.unique(owner[inside[bad[number]]])
        if len(failing):
            keep = np.ones(len(words), bool)
            keep[failing] = False
            merged, exact = self._merge_all([words[i] for i in failing.tolist()])
            stay = keep[owner]
            owner = np.concatenate([owner[stay], failing[merged]])
            token = np.concatenate([token[stay], exact])
            order = np.argsort(owner, kind="stable")
            owner, token = owner[order], token[order]
        return token, np.searchsorted(owner, np.arange(len(words) + 1)), len(failing)

    def split_words(self, piece: str) -> list[str]:
        """The words of the pre-tokenizer."""
        if piece.isascii() or self.rare.search(piece) is None:
            return self.words.findall(piece)
        if self.cutter is None:
            from tokenizers import Tokenizer

            self.cutter = Tokenizer.from_file(self.path).pre_tokenizer
        return [piece[a:b] for _, (a, b) in self.cutter.pre_tokenize_str(piece)]

    def pieces(self, text: str) -> Iterator[list[str]]:
        """Lists of pieces that are encoded alone, a window of a long text at a time."""
        start = 0
        while start < len(text):
            cut = self.cut.search(text, start + WINDOW) if len(text) - start > WINDOW else None
            window = text[start : cut.start() if cut else len(text)]
            start += len(window)
            if self.gap.search(window) is None:
                first, *others = window.split(" ")
                yield [first, *(" " + w for w in others)] if first else [" " + w for w in others]
            else:
                ends = [0, *(m.start() for m in self.cut.finditer(window)), len(window)]
                yield [window[a:b] for a, b in zip(ends, ends[1:], strict=False) if a < b]

    def encode(self, texts: Iterable[str]) -> Iterator[np.ndarray]:
        """The ids of each text. A special token's content is that token, wherever it stands.

        New pieces of a window's length of texts are encoded together, however many texts that are.
        """
        waiting, size = [], 0
        for text in texts:
            ids: list[bytes] = []
            waiting.append((ids, []))
            for pieces in self._parts(text):
                waiting.append((ids, pieces))
                size += sum(map(len, pieces))
                if size >= WINDOW:
                    yield from self._flush(waiting, last=ids)
                    waiting, size = [(ids, [])], 0
        yield from self._flush(waiting)

    def _parts(self, text: str) -> Iterator[list[str]]:
        if not any(content in text for content in self.special):
            yield from self.pieces(text)
            return
        for part in re.split(f"({'|'.join(map(re.escape, self.special))})", text):
            if part in self.special:
                yield [part]
            else:
                yield from self.pieces(part)

    def _flush(self, waiting: list, last: list[bytes] | None = None) -> Iterator[np.ndarray]:
        """Encode what waits; give the ids of all texts but the last, which may go on."""
        memory = self.memory
        self._remember({p for _, pieces in waiting for p in pieces if p not in memory})
        done = None
        for ids, pieces in waiting:
            if done is not None and done is not ids:
                yield np.frombuffer(b"".join(done), np.int32)
            done = ids
            ids += map(memory.__getitem__, pieces)
        if done is not None and done is not last:
            yield np.frombuffer(b"".join(done), np.int32)
        if len(self.memory) > MEMORY:
            self.memory = self._specials()

    def _specials(self) -> dict[str, bytes]:
        return {content: np.int32(i).tobytes() for content, i in self.special.items()}

    def _remember(self, pieces: set[str]) -> None:
        # Most pieces are one word of letters, perhaps behind a blank.
        alone = {p for p in pieces if p[1:].isalpha() and (p[0] == " " or p[0].isalpha()) and max(p) < RARE}
        several = {p: self.split_words(p) for p in pieces - alone}
        memory = self.memory
        words = [w for w in alone | {w for found in several.values() for w in found} if w not in memory]
        if words:
            token, starts, _ = self.encode_words([w.encode() for w in words])
            data, cuts = token.astype("<i4").tobytes(), (starts * 4).tolist()
            cut = map(data.__getitem__, map(slice, cuts, cuts[1:]))
            memory.update(zip(words, cut, strict=True))
        memory.update((p, b"".join([memory[w] for w in found])) for p, found in several.items())

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids, special tokens included; an id without a token is left out, and bytes that are
        no UTF-8 become U+FFFD."""
        tokens = self.tokens
        return b"".join([tokens.get(i, b"") for i in ids.tolist()]).decode("utf-8", "replace")


def encode(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    vocabulary: str | None = None,
    decoded: bool = False,
) -> DataFrame:
    """row_key, doc_id and ids, the token ids of every row's text; with `decoded` also the text that these
    ids are decoded to, as `decode` does, in the same pass.

    A missing text is an empty one and has no ids. Rows repeat as often as they are there, ids may be
    missing or repeated; other columns are not looked at. An empty table gives no rows. `vocabulary` is a
    file that every executor has.
    """
    texts = texts_of(docs, id_col, text_col)

    def rows(batches):
        import pyarrow as pa

        bpe = ByteBPE(vocabulary)
        for batch in slices(batches, "body", SLICE):
            ids = list(bpe.encode(body.decode("utf-8", "replace") for body in cells(batch, "body")))
            ends = np.cumsum([0, *map(len, ids)])
            found = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(ids), pa.int32()))
            columns = {"row_key": field(batch, "row_key"), "doc_id": field(batch, "doc_id"), "ids": found}
            if decoded:
                columns["decoded"] = pa.array([bpe.decode(x) for x in ids], pa.string())
            yield pa.RecordBatch.from_pydict(columns)

    id_type = texts.schema["doc_id"].dataType.simpleString()
    last = ", decoded string" if decoded else ""
    return texts.mapInArrow(rows, f"row_key string, doc_id {id_type}, ids array<int>{last}")


def decode(encoded: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """The rows of `encoded` (row_key, doc_id, ids) with `decoded`, the text of the ids.

    Missing ids are none; special tokens stand for their content, and an id that is no token for nothing.
    """
    rows_of = encoded.select("row_key", "doc_id", "ids")

    def rows(batches):
        import pyarrow as pa

        bpe = ByteBPE(vocabulary)
        for batch in batches:
            ids = field(batch, "ids")
            found = [bpe.decode(x.values.drop_null().to_numpy()) if x.is_valid else "" for x in ids]
            yield pa.RecordBatch.from_pydict(
                {**dict(zip(batch.schema.names, batch.columns, strict=True)), "decoded": pa.array(found, pa.string())}
            )

    id_type = rows_of.schema["doc_id"].dataType.simpleString()
    return rows_of.mapInArrow(rows, f"row_key string, doc_id {id_type}, ids array<int>, decoded string")


def round_trip_digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """row_key, doc_id, n_tokens, ids_sha256 and decoded_sha256 of every row, encoded and decoded again."""
    there_and_back = encode(docs, id_col, text_col, decoded=True)
    return there_and_back.select(
        "row_key",
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
