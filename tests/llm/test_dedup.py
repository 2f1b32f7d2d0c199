"""Exact and near duplicates, and components, against brute force."""

from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pytest

from caseload.llm.components import components
from caseload.llm.exact_dedup import drop_exact_copies, exact_groups
from caseload.llm.simhash import (
    drop_near_copies,
    fingerprint,
    grow_trees,
    links,
    near_groups,
    search_trees,
    shard_chains,
    shards,
)

import brute


def some_texts(seed=3, n=60):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(40)]
    texts = [" ".join(rng.choices(words, k=rng.choice([1, 2, 3, 8, 60, 200]))) for _ in range(n)]
    for t in texts[:20]:
        w = t.split()
        w[rng.randrange(len(w))] = "changed"
        texts += [t.upper(), t.replace(" ", "  "), " ".join(w)]
    return texts


def exact_rows(df):
    cols = ("doc_id", "keep_id", "group_size", "text_sha256")
    return Counter(tuple(r[c] for c in cols) for r in df.collect())


def test_exact_groups_are_those_of_brute_force(spark):
    docs = brute.awkward(spark, some_texts())
    groups = exact_groups(docs)
    assert exact_rows(groups) == Counter(brute.exact(brute.ids_and_texts(docs)))
    # One row of each group is kept, also where ids repeat or are missing.
    kept = Counter(r["text_sha256"] for r in groups.where("kept").collect())
    assert set(kept.values()) == {1}
    assert set(kept) == {r["text_sha256"] for r in groups.collect()}


def test_colliding_hashes_are_told_apart_by_their_bytes(spark):
    docs = brute.awkward(spark, some_texts())
    weak = exact_groups(docs, hash_of=lambda content: bytes([len(content) % 3]))
    assert exact_rows(weak) == exact_rows(exact_groups(docs))
    assert weak.where("kept").count() == exact_groups(docs).where("kept").count()


def test_dropping_exact_copies_keeps_all_columns(spark):
    docs = brute.awkward(spark, some_texts())
    kept = drop_exact_copies(docs)
    assert kept.columns == docs.columns
    contents = ["".join(c for c in t or "" if c not in brute.WHITE) for _, t in brute.ids_and_texts(kept)]
    assert len(contents) == len(set(contents))
    assert kept.count() == len({x[3] for x in brute.exact(brute.ids_and_texts(docs))})


@pytest.mark.parametrize("run", [exact_groups, drop_exact_copies, near_groups, drop_near_copies])
def test_an_empty_table_gives_no_rows(spark, run):
    assert run(brute.empty(spark)).count() == 0


def test_fingerprints_of_long_texts_do_not_depend_on_where_they_are_cut(monkeypatch):
    import caseload.llm.simhash as simhash

    text = " ".join(some_texts()).encode()
    whole = fingerprint(text)
    assert whole == brute.fingerprint(text.decode())
    for size in (1, 7, 100):
        monkeypatch.setattr(simhash, "WORDS_BYTES", size)
        assert fingerprint(text) == whole
        assert [fingerprint(t) for t in (b"", b" \n", b"One", b"a  B")] == [
            brute.fingerprint(t) for t in ("", " \n", "One", "a  B")
        ]


def test_near_groups_are_those_of_brute_force(spark):
    docs = brute.awkward(spark, some_texts())
    found = Counter((r["doc_id"], r["fingerprint"], r["component_id"]) for r in near_groups(docs).collect())
    assert found == Counter(brute.near(brute.ids_and_texts(docs)))


def test_one_row_of_each_near_group_stays(spark):
    docs = brute.awkward(spark, some_texts())
    kept = drop_near_copies(docs)
    assert kept.columns == docs.columns
    components_of = brute.near(brute.ids_and_texts(docs))
    assert kept.count() == len({c if c is not None else f for _, f, c in components_of})
    ids = [r["doc_id"] for r in kept.collect() if r["doc_id"] is not None]
    assert sorted(ids) == sorted({c for _, _, c in components_of if c is not None})


def near_prints(seed=5, centres=4, each=150, lone=200):
    rng = np.random.default_rng(seed)
    prints = list(rng.integers(0, 1 << 63, lone))
    for c in rng.integers(0, 1 << 63, centres):
        for _ in range(each):
            flips = rng.integers(0, 64, rng.integers(0, 5))
            prints.append(int(c) ^ sum(1 << int(b) for b in set(flips)) & (1 << 63) - 1)
    return np.unique(np.array(prints, np.uint64))


def test_trees_find_all_pairs_within_the_radius():
    prints = near_prints()
    roots, edge, child = grow_trees(np.zeros(len(prints), np.int64), prints)
    assert len(child) == len(prints) - 1
    for radius in (0, 1, 2, 5):
        found = set()
        for a, b in search_trees(prints, roots, edge, child, np.arange(len(prints)), radius):
            found |= set(zip(a.tolist(), b.tolist(), strict=True))
        apart = np.bitwise_count(prints[:, None] ^ prints[None, :])
        assert found == set(zip(*(x.tolist() for x in np.nonzero(apart <= radius)), strict=True))


def test_several_trees_stay_apart():
    prints = np.tile(near_prints(each=20, lone=5), 2)
    tree = np.repeat([0, 1], len(prints) // 2)
    a, b = shard_chains(tree, prints, 2)
    one, two = shard_chains(tree[tree == 0], prints[tree == 0], 2)
    assert sorted(zip(a, b, strict=True)) == sorted([*zip(one, two, strict=True)] * 2)


def test_shards_are_small_and_hold_every_pair(spark):
    prints = near_prints()
    frame = spark.createDataFrame([(int(p),) for p in prints.view(np.int64)], "fingerprint bigint")
    most = 16
    rows = shards(frame, 2, most).collect()
    members = {}
    for r in rows:
        members.setdefault((r["mask"], r["value"]), []).append(r["fingerprint"])
    assert max(map(len, members.values())) <= most
    together = {(a, b) for m in members.values() for a in m for b in m}
    signed = prints.view(np.int64)
    apart = np.bitwise_count(prints[:, None] ^ prints[None, :])
    for i, j in zip(*np.nonzero(apart <= 2), strict=True):
        assert (int(signed[i]), int(signed[j])) in together
    # And their chains connect what brute force connects.
    roots = {r["node"]: r["root"] for r in components(links(frame, 2, most)).collect()}
    expected = brute.linked([int(p) for p in prints], lambda a, b: (a ^ b).bit_count() <= 2)
    groups = {}
    for p, r in zip(signed, expected, strict=True):
        groups.setdefault(r, set()).add(roots.get(int(p), int(p)))
    assert all(len(g) == 1 for g in groups.values())
    assert len({x for g in groups.values() for x in g}) == len(groups)


def test_components_of_chains_stars_and_loops(spark):
    chain = [(i, i + 1) for i in range(300)]
    star = [(1000, 1000 + i) for i in range(1, 100)]
    ring = [(2000 + i, 2000 + (i + 1) % 50) for i in range(50)]
    edges = spark.createDataFrame([*chain, *star, *ring, (3000, 3000), (1, 0)], "a bigint, b bigint")
    found = {}
    for r in components(edges).collect():
        found.setdefault(r["root"], set()).add(r["node"])
    assert sorted(map(len, found.values())) == [1, 50, 100, 301]
    assert components(edges.limit(0)).count() == 0
