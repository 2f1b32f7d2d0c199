"""The Merkle manifest against a plain build of the same trees."""

from __future__ import annotations

import zlib
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from caseload.llm.merkle import manifest

SCHEMA = "doc_id bigint, source string, lang string, n_chars bigint, text string, node string, pos int, `tree` string"
COLUMNS = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def digest(text):
    return sha256(text.encode()).hexdigest()


def leaf(row, text):
    fields = (row.doc_id, row.source, row.lang, row.n_chars, text)
    return digest("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in fields))


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([digest("".join(out[-1][i : i + 3])) for i in range(0, len(out[-1]), 3)])
    return out


def siblings(tree, i):
    out = []
    for level in tree[:-1]:
        first = i - i % 3
        out.append(("".join(level[first:i]), "".join(level[i + 1 : first + 3])))
        i //= 3
    return out


def plain(rows):
    trees = {}
    for r in rows:
        trees.setdefault(r.source, []).append(r)
    order = sorted(trees, key=lambda s: (s is not None, (s or "").encode()))
    for s in order:
        trees[s].sort(key=lambda r: (r.doc_id is not None, r.doc_id or 0, leaf(r, r.text)))
    built = {s: levels([leaf(r, r.text) for r in trees[s]]) for s in order}
    top = levels([built[s][-1][0] for s in order])
    out = []
    for k, s in enumerate(order):
        for i, r in enumerate(trees[s]):
            path = siblings(built[s], i) + siblings(top, k)
            text = r.text
            if r.doc_id is not None and text is not None and zlib.crc32(str(r.doc_id).encode()) % 2 == 0:
                text = text.replace("\n", "")
            node = leaf(r, text)
            for a, b in path:
                node = digest(a + node + b)
            proof = digest("".join(a + b for a, b in path))
            out.append((r.doc_id, built[s][0][i], built[s][-1][0], top[-1][0], proof, node, node == top[-1][0]))
    return sorted(map(str, out))


def rows(spark, n, sources):
    texts = [None, "", "a\nb", "line\n\nline " * 40, "ünï\n漢字", "x" * 5000]
    made = [
        (i if i % 11 else None, sources[i % len(sources)], None if i % 5 == 0 else "en", i * 7 if i % 3 else None,
         texts[i % len(texts)], "n", 1, "t")
        for i in range(n)
    ]
    return spark.createDataFrame(made + made[: n // 4], SCHEMA)


@pytest.mark.parametrize("height", [1, 2, 6])
@pytest.mark.parametrize("sources", [["a"], [None, "b", "é", "B", "", "a"], [f"s{i}" for i in range(40)]])
def test_all_trees_equal_a_plain_build(spark, height, sources):
    docs = rows(spark, 130, sources)
    found = manifest(docs, height=height, proofs=False).select(*COLUMNS).collect()
    assert sorted(str(tuple(r)) for r in found) == plain(docs.collect())


def test_a_source_with_a_third_of_all_rows_takes_several_rounds(spark):
    docs = spark.range(900).select(
        F.col("id").alias("doc_id"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("s"), F.col("id") % 20)).alias("source"),
        F.lit("en").alias("lang"), F.col("id").alias("n_chars"), F.lit("some\ntext").alias("text"),
    )
    found = manifest(docs, height=1, proofs=False).select(*COLUMNS).collect()
    assert sorted(str(tuple(r)) for r in found) == plain(docs.collect())


def test_proofs_lead_from_the_leaf_to_the_root(spark):
    docs = rows(spark, 60, ["a", "b", None])
    for r in manifest(docs, height=1).collect():
        node = r.leaf
        for a, b in zip(r.left, r.right, strict=True):
            node = digest(a + node + b)
        assert node == r.root
        assert r.proof_sha256 == digest("".join(a + b for a, b in zip(r.left, r.right, strict=True)))
        assert r.verified == (r.folded_root == r.root)


def test_one_row_and_none(spark):
    one = rows(spark, 1, ["only"])
    r = manifest(one).collect()
    assert len(r) == 1 and r[0].leaf == r[0].subroot == r[0].root
    assert r[0].proof_sha256 == digest("") and r[0].left == []
    assert manifest(one.limit(0)).count() == 0


def test_text_ids_and_other_names(spark):
    docs = rows(spark, 20, ["a", "b"]).withColumn("key", F.concat(F.lit("k"), F.coalesce("doc_id", F.lit(0))))
    found = manifest(docs, "key", "source", "text", ("key", "source", "text")).collect()
    assert len(found) == docs.count()
    assert {r.doc_id for r in found} == {r.key for r in docs.collect()}
