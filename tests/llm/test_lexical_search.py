"""Lexical search against scores of all documents, and what its pair bounds save."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import brute
import numpy as np
import pyarrow as pa

from caseload.llm import lexical_search
from caseload.llm.lexical_search import List, Lists, Shard, Unit, best_in_shard, search, terms_of

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return TERM.findall(lower)


def weights(counts):
    n = sum(1 for c in counts if c)
    df = Counter(t for c in counts for t in c)
    return n, {t: math.floor(1000 * math.log((2 * n + 2) / (2 * f + 1))) for t, f in df.items()}


def ranked(docs, items):
    counts = [Counter(terms(t)) for _, t in docs]
    n, w = weights(counts)
    total = sum(sum(c.values()) for c in counts)
    out = []
    for item, text in items:
        found = []
        for (i, _), c in zip(docs, counts, strict=True):
            m = 100 - 90 + (90 * sum(c.values()) * n) // total if c else 0
            score = sum(w[t] * ((1000000000 * c[t]) // (1000 * c[t] + 8 * m)) for t in set(terms(text)) if t in c)
            if score > 0:
                found.append((-score, i is None, i or 0, i))
        out += [(item, k + 1, x[3], -x[0]) for k, x in enumerate(sorted(found)[:10])]
    return sorted(out, key=str)


def found_by(docs, items, **options):
    rows = search(docs, items, item_col="item_id", **options).collect()
    return sorted(((r.item_id, r["rank"], r.doc_id, r.score) for r in rows), key=str)


def words(rng, n):
    return " ".join(f"w{min(int(rng.paretovariate(0.6)), 400)}" for _ in range(n))


def test_odd_rows(spark):
    docs = brute.awkward(spark, ["The the THE fox", "fox,dog;cat", "é É straße", "the quick brown fox", "..."])
    texts = ["the quick brown fox", "Straße é 漢字", None, "", "...", "nowhere found", "word5 the OF no id here", "the quick brown fox"]
    items = spark.createDataFrame([(i if i else None, t, "x") for i, t in enumerate(texts)], "item_id int, text string, term string")
    expected = ranked(brute.ids_and_texts(docs), [(r.item_id, r.text) for r in items.collect()])
    assert found_by(docs, items) == expected
    assert found_by(docs, items, shard_bytes=50, block_terms=2) == expected
    assert found_by(brute.empty(spark), items) == []
    assert found_by(docs, items.limit(0)) == []
    assert found_by(brute.empty(spark), items.limit(0)) == []


def test_many_documents_in_many_shards_and_blocks(spark):
    rng = random.Random(11)
    docs = [(i, words(rng, rng.randint(1, 60))) for i in range(1500)] + [(i, "w1 w2 w3") for i in range(5000, 5400)]
    items = [(i, words(rng, rng.randint(1, 25))) for i in range(30)] + [(99, "w1 w2 w3")]
    a = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(5)
    b = spark.createDataFrame(items, "item_id bigint, text string")
    assert found_by(a, b, shard_bytes=6000, block_terms=60) == ranked(docs, items)


def test_terms_of_long_texts(monkeypatch):
    monkeypatch.setattr(lexical_search, "PART", 20)
    text = "Some-Words é漢字 " * 30 + "x" * 500 + " end"
    assert [w.decode() for part in terms_of(text.encode()) for w in part] == terms(text)


def lists(docs):
    shard = Shard()
    for i, text in enumerate(docs):
        shard.add(i, text.encode())
    row = shard.row("s", pa.int64())
    return Lists(row, row["docs"], row["words"])


def test_pair_bounds_hold_and_are_tighter():
    rng = random.Random(2)
    docs = [words(rng, rng.randint(5, 80)) for _ in range(600)]
    here = lists(docs)
    counts = [Counter(terms(t)) for t in docs]
    _, w = weights(counts)
    impact = {t: dict(zip(*(x.tolist() for x in here.list_of(t.encode(), w[t])[:2]), strict=True)) for t in w}
    tighter = 0
    names = sorted(w, key=lambda t: -w[t])
    for a, b in zip(names[::2], names[1::2], strict=False):
        unit = here.pair((a.encode(), w[a]), (b.encode(), w[b]))
        best = max(impact[a].get(d, 0) + impact[b].get(d, 0) for d in range(len(docs)))
        assert best == unit.bound <= unit.apart
        tighter += unit.bound < unit.apart
    assert tighter > len(names) // 4


def test_pair_bounds_skip_more_and_change_nothing():
    rng = random.Random(4)
    docs = [words(rng, rng.randint(5, 120)) for _ in range(3000)]
    counts = [Counter(terms(t)) for t in docs]
    _, w = weights(counts)
    here, with_pairs, without, all_read = lists(docs), 0, 0, 0
    for _ in range(40):
        asked = [(t.encode(), w[t]) for t in set(terms(words(rng, 12))) if w.get(t, 0) > 0]
        places, scores, read = best_in_shard(here, asked)
        other_places, other_scores, other_read = best_in_shard(here, asked, pair_bounds=False)
        assert places.tolist() == other_places.tolist() and scores.tolist() == other_scores.tolist()
        with_pairs, without = with_pairs + read, without + other_read
        all_read += sum(len(here.list_of(*t)[0]) for t in asked if here.list_of(*t))
    assert with_pairs < without < all_read / 2


def test_a_floor_is_reached_by_ten_documents():
    places, scores = np.arange(12), np.arange(12)[::-1] * 5
    one, other = List(places, scores, 55, 10), List(places[:3], scores[:3], 55, 0)
    unit = Unit([one, other], np.array([110, 100, 90]))
    assert unit.floor == 10 and unit.bound == unit.apart == 110
