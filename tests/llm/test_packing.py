"""Pieces and sequences against the tokenizer and the rules of packing."""

from __future__ import annotations

from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from caseload.llm.packing import Encoder, best_fit, crossed, evolve, lower_bound, pack, piece_lengths, worth

import brute


@pytest.fixture(scope="module")
def encoder():
    return Encoder()


@pytest.fixture(scope="module")
def tokenizer():
    import public_tokenizers
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


ODD = (
    "", " ", "  ", "a", " a ", "a  b", "a   b", "a \n b", "a\n \nb", "a \t b  ", "don't we'll  I'd", "x\x1c y \x85 z",
    "<|endoftext|>", "a <|endoftext|> b", "naïve ÀÉ straße", "漢字 かな", "👍🏽 ok", "a b   c", "12 345,67 %%% ###",
)


@pytest.mark.parametrize("text", ODD)
def test_ids_are_those_of_the_tokenizer(encoder, tokenizer, text):
    expected = tokenizer.encode(text, add_special_tokens=False).ids
    for _ in range(2):  # the second time from memory
        assert np.frombuffer(encoder.document(text), "<u4").tolist() == expected


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from(" \n\t ab'sé,.!#1漢\x1c"), max_size=30))
def test_ids_of_any_text(encoder, tokenizer, text):
    expected = tokenizer.encode(text, add_special_tokens=False).ids
    assert np.frombuffer(encoder.document(text), "<u4").tolist() == expected


def test_only_the_first_piece_is_short():
    assert piece_lengths(1, 4) == [1]
    assert piece_lengths(4, 4) == [4]
    assert piece_lengths(9, 4) == [1, 4, 4]


lengths_of = st.lists(st.integers(1, 63), min_size=1, max_size=60)


def packed(lengths, most=64):
    place, free = [0] * len(lengths), []
    best_fit(lengths, list(range(len(lengths))), place, free, most)
    return np.array(place)


@settings(max_examples=100, deadline=None)
@given(lengths_of, st.integers(0, 100))
def test_packings_hold_and_crossing_keeps_every_piece(values, seed):
    lengths = np.array(sorted(values, reverse=True))
    one = packed(lengths.tolist())
    other = np.arange(len(lengths))
    child = crossed(one, other, lengths, 64, np.random.default_rng(seed))
    again = crossed(child, one, lengths, 64, np.random.default_rng(seed))
    for place in (one, child, again, evolve(lengths, [one], 64, [seed])):
        fill = np.bincount(place, weights=lengths)
        assert len(place) == len(lengths)
        assert fill.max() <= 64
        assert fill.min() > 0
        assert len(fill) >= lower_bound(lengths, 64)


def test_evolving_is_no_worse_than_best_fit():
    rng = np.random.default_rng(1)
    lengths = np.sort(rng.integers(10, 60, 400))[::-1]
    best = evolve(lengths, [], 64, [0])
    assert worth(best, lengths, 64) <= worth(packed(lengths.tolist()), lengths, 64)


def check(docs, found):
    rows = found.collect()
    expected = brute.pieces(brute.ids_and_texts(docs))
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == expected
    sequences = defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
    for places in sequences.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= 1024
    return len(sequences), sum(r.length for r in rows)


def test_packing_awkward_rows(spark):
    docs = brute.awkward(spark, ODD)
    check(docs, pack(docs))
    assert pack(brute.empty(spark)).count() == 0


def test_packing_is_close_to_the_lower_bound(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    sequences, tokens = check(docs, pack(docs))
    assert sequences <= 1.01 * -(-tokens // 1024)
