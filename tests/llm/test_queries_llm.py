"""All registered queries on whole tables, those with SQL against DuckDB, and the pipeline by stages."""

from __future__ import annotations

import sys
from collections import Counter, defaultdict
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import brute
from compare import connect, differences

import corpus_pipeline
from caseload.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SMALL)


@pytest.mark.parametrize("name", [n for n, (_, sql) in QUERIES.items() if sql])
def test_queries_equal_their_sql(spark, con, name):
    query, sql = QUERIES[name]
    assert differences(con, spark, SMALL, query, sql) == []


@pytest.mark.parametrize("name", [n for n, (_, sql) in QUERIES.items() if not sql])
def test_queries_return_whole_tables(spark, con, name):
    rows = QUERIES[name][0](spark, SMALL).collect()
    table, key = ("pages", "page_id") if name.startswith("op10") else ("documents", "doc_id")
    ids = {i for (i,) in con.execute(f"SELECT {key} FROM {table}").fetchall()}
    assert {r[key] for r in rows} == ids
    assert name.startswith("op2") or len(rows) == len(ids)


def test_simhash_query_against_brute_force(spark, con):
    rows = con.execute("SELECT doc_id, text FROM documents").fetchall()
    found = Counter(tuple(r) for r in QUERIES["op1_simhash_near_dedup"][0](spark, SMALL).collect())
    assert found == Counter(brute.near(rows))


def test_personal_data_query_against_brute_force(spark, con):
    rows = con.execute("SELECT doc_id, text FROM documents").fetchall()
    for r in QUERIES["op3_personal_data"][0](spark, SMALL).collect():
        assert set(brute.personal(dict(rows)[r["doc_id"]]).split(",")) <= set(r["spans"].split(","))


def test_every_operator_is_registered():
    assert [n.split("_")[0] for n in sorted(QUERIES, key=lambda n: int(n[2:].split("_")[0]))] == [
        f"op{i}" for i in range(1, 14)
    ]


def test_each_stage_keeps_what_brute_force_keeps(spark, con, tmp_path):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns = docs.columns
    before = brute.ids_and_texts(docs)
    quality = {i: q for i, q in con.execute("SELECT doc_id, quality FROM labels").fetchall()}
    benchmark = con.execute("SELECT item_id, text FROM benchmark").fetchall()
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SMALL).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        if name == "pack":
            break
        assert docs.columns == columns
        after = brute.ids_and_texts(docs)
        assert not Counter(after) - Counter(before)
        kept = {i for i, _ in after}
        if name == "quality":
            good = [i for i, _ in before if quality.get(i) == 1]
            bad = [i for i, _ in before if quality.get(i) == 0]
            assert sum(i in kept for i in good) >= 0.97 * len(good)
            assert sum(i in kept for i in bad) <= 0.5 * len(bad)
        elif name == "exact_dedup":
            assert kept == {k for _, k, _, _ in brute.exact(before)}
        elif name == "near_dedup":
            assert kept == {c for _, _, c in brute.near(before)}
        elif name == "decontaminate":
            assert kept == {r[0] for r in brute.contamination(before, benchmark) if not r[5]}
        before = after
    found = docs.collect()
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in found) == brute.pieces(before)
    fill = defaultdict(int)
    for r in found:
        fill[r.sequence_id] += r.length
    assert max(fill.values()) <= 1024


def test_the_pipeline_takes_awkward_rows(spark, tmp_path):
    from pyspark.sql import functions as F

    table = spark.read.parquet(f"{SMALL}/documents.parquet")
    awkward = brute.awkward(spark, [None, "", "x"]).select("doc_id", "text")
    extra = [F.lit(None).cast(table.schema[c].dataType).alias(c) for c in table.columns[2:]]
    docs = awkward.select("doc_id", "text", *extra)
    for rows in (docs, docs.limit(0)):
        read = rows
        for name, stage in corpus_pipeline.STAGES:
            path = str(tmp_path / f"{name}-{rows is docs}")
            stage(spark, read, SMALL).write.parquet(path)
            read = spark.read.parquet(path)
        assert (read.count() > 0) == (rows is docs)


def test_run_packs_the_whole_table(spark):
    assert corpus_pipeline.run(spark, SMALL).where("length > 0").count() > 100


FAR = """
import sys
sys.path.insert(0, {root!r})
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[4]").config("spark.ui.enabled", "false").getOrCreate()
from __spark_entry__ import queries
spark.conf.set("spark.sql.shuffle.partitions", "4")
for name, query in queries().items():
    if name.startswith("op"):
        print(name, query(spark, {small!r}).count())
"""


def test_workers_need_no_copy_of_the_package(tmp_path):
    """From another folder, and without a folder named for checkpoints."""
    import os
    import subprocess

    script = FAR.format(root=str(Path(__file__).resolve().parents[2]), small=SMALL)
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run(
        [sys.executable, "-c", script], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=900
    )
    lines = [line.split() for line in done.stdout.splitlines() if line.startswith("op")]
    assert len(lines) == len(QUERIES), done.stderr[-2000:]
    assert all(int(n) > 0 for _, n in lines)
