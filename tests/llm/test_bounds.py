"""Beyond the bounds that operators once had, and frames that repeat rows of files."""

from __future__ import annotations

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import brute
from caseload.llm import pii, quality
from caseload.llm.chat import formatted_chats
from caseload.llm.decontaminate import contamination, drop_contaminated
from caseload.llm.exact_dedup import drop_exact_copies, exact_groups
from caseload.llm.html_extract import Model
from caseload.llm.html_pages import labelled_pages
from caseload.llm.queries import QUERIES
from caseload.llm.rows import read_table, row_key
from caseload.llm.simhash import near_groups

SMALL = "/root/testdata/sf0.001"


# Rows of a frame that repeats rows of files.


def halves(spark):
    """Each document as two rows: its first 40 characters, and the rest."""
    docs = read_table(spark, SMALL, "documents").select("doc_id", "text")
    parts = F.array(F.substring("text", 1, 40), F.substring("text", 41, 10**6))
    return docs.select("doc_id", F.explode(parts).alias("text"))


def test_row_keys_of_repeated_file_rows_are_distinct(spark):
    docs = read_table(spark, SMALL, "documents")
    frames = [docs, docs.where("doc_id > 3").limit(50), halves(spark), docs.union(docs), docs.crossJoin(spark.range(2))]
    for frame in frames:
        keys = [r[0] for r in frame.select(row_key(frame)).collect()]
        assert len(set(keys)) == len(keys) > 0


def test_exploded_rows_lose_no_text(spark):
    rows = halves(spark)
    contents = {"".join(c for c in t or "" if c not in brute.WHITE) for _, t in brute.ids_and_texts(rows)}
    kept = brute.ids_and_texts(drop_exact_copies(rows))
    assert len(kept) == len(contents)
    assert {"".join(c for c in t or "" if c not in brute.WHITE) for _, t in kept} == contents
    assert exact_groups(rows).where("kept").count() == len(contents)


def test_exploded_rows_in_groups_of_near_copies(spark):
    rows = halves(spark)
    found = near_groups(rows).groupBy("doc_id").count().collect()
    assert {r["count"] for r in found} == {2}


def test_paragraphs_that_documents_share(spark, tmp_path):
    spark.createDataFrame(
        [(1, ["shared words", "only in one"]), (2, ["shared words", "only in two"])], "doc_id int, texts array<string>"
    ).coalesce(1).write.parquet(str(tmp_path / "t"))
    rows = spark.read.parquet(str(tmp_path / "t")).select("doc_id", F.explode("texts").alias("text"))
    kept = sorted(t for _, t in brute.ids_and_texts(drop_exact_copies(rows)))
    assert kept == ["only in one", "only in two", "shared words"]


# Offsets of either width.


@pytest.mark.parametrize("large", ["true", "false"])
def test_contamination_with_large_offsets(spark, large):
    setting = "spark.sql.execution.arrow.useLargeVarTypes"
    before = spark.conf.get(setting)
    docs, items = read_table(spark, SMALL, "documents"), read_table(spark, SMALL, "benchmark")
    expected = brute.contamination(brute.ids_and_texts(docs), [(r.item_id, r.text) for r in items.collect()])
    spark.conf.set(setting, large)
    try:
        found = contamination(docs, items).select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
        assert sorted(map(tuple, found.collect())) == sorted(expected)
        kept = {r.doc_id for r in drop_contaminated(docs, items).collect()}
        assert kept == {r[0] for r in expected if not r[5]}
        for name in ("op4_exact_dedup", "op7_quality_classifier", "op11_bpe_round_trip", "op13_lexical_search"):
            assert QUERIES[name][0](spark, SMALL).count() > 0
    finally:
        spark.conf.set(setting, before)


# Conversations with several turns of one number.


def test_conversations_of_many_turns_by_their_sql(spark):
    rows = [(1, i // 2, "user" if i % 2 else "bot", f"turn {i}") for i in range(600)]
    rows += [(2, i % 3, "user", f"said {i:04}") for i in range(1000)] + [(3, 0, "user", "hi"), (3, 1, None, None)]
    turns = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    conversations = turns.toPandas()  # noqa: F841
    sql = QUERIES["op9_chat_formatting"][1]
    found = formatted_chats(turns)
    expected = duckdb.sql(sql)
    columns = expected.columns
    assert sorted(tuple(r[c] for c in columns) for r in found.collect()) == sorted(expected.fetchall())
    pieces = {(r.conv_id, r.part, r.piece) for r in found.collect()}
    assert pieces == {(1, 0, 0), (1, 0, 1), (1, 1, 0), *((2, 0, i) for i in range(4)), (3, 0, 0)}


def test_turns_and_labels_that_are_no_numbers(spark):
    rows = [(1, "0", "user", "a"), (1, "one", "bot", "b"), (1, None, "bot", "c")]
    turns = spark.createDataFrame(rows, "conv_id bigint, turn string, role string, text string")
    found = formatted_chats(turns).orderBy("part").collect()
    assert [(r.part, r.n_turns) for r in found] == [(-1, 3), (0, 3)]
    assert found[0].text.count("<|im_start|>") == 2
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(20)], "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, "1" if i % 2 else "bad") for i in range(20)], "doc_id bigint, quality string")
    assert quality.quality_scores(docs, quality.trained(docs, labels)).count() == 20


# Personal data behind long gaps and of any length.


def test_words_before_a_span_however_far():
    for gap in (1, 250, 5000):
        assert pii.contexts("please call me at" + " " * gap + "555", 17 + gap) == ["at", "me at"]
    long = "x" * 3000
    assert pii.contexts(f"{long} at 555", len(long) + 4) == ["at", f"{long} at"]
    assert pii.contexts(f"{long} 555", len(long) + 1) == [long]


def test_shapes_of_any_length():
    for n in (10, 64, 65, 500):
        text = f"write {'a' * n}(at){'b' * n}.com now"
        assert [(s, k) for s, k, _ in pii.candidates(text, [])] == [(6, 0)]
    for gap in (1, 30, 300):
        text = f"call 555{' ' * gap}123 {'-' * gap} 4567 now"
        assert [(s, k, text[e - 1]) for s, k, e in pii.candidates(text, [])] == [(5, 3, "7")]
    assert pii.candidates("(" * 100_000 + " 1 " * 50_000, []) == []


def test_digit_runs_begin_and_end_where_numbers_do():
    cases = {
        "call (555) 123-4567.": "(555) 123-4567", "x555-123-4567": "123-4567", "v1.555-1234": None, "555-123-4567a": None,
        "555 1234 777b": "555 1234", "tel 555.123.4567 or": "555.123.4567", "+1 555 123 4567": "555 123 4567",
    }
    for text, expected in cases.items():
        found = [text[s:e] for s, e in pii.digit_runs(text)]
        assert found == ([expected] if expected else []), text


# Blanks between the parts of an article.


@pytest.fixture(scope="module")
def model():
    return Model(labelled_pages())


ARTICLE = (
    "<html><head><title>t</title></head><body><nav><a href='/'>Home</a></nav><article><h1>The long title of it</h1>"
    "<p>A first paragraph with quite a few words in it, so that it is one.</p><p>{}</p>"
    "<p>A last paragraph with quite a few words in it, so that it is one too.</p></article></body></html>"
)


@pytest.mark.parametrize(
    "inner, text",
    [
        ("one<b> </b>two words", "one two words"),
        ("one<span> <b>two</b></span> words", "one two words"),
        ("one<span><br>two</span> words", "one two words"),
        ("one <b>two</b>words", "one twowords"),
        ("one<br/><br>two<i>\n</i>words", "one two words"),
        ("one&nbsp;<em>two</em>&#32;words", "one two words"),
        ("one<b>two</b>words", "onetwowords"),
    ],
)
def test_blanks_of_an_article_stay(model, inner, text):
    assert text in model.extract(ARTICLE.format(inner)).split("\n\n")


def test_blanks_do_not_cross_blocks(model):
    page = ARTICLE.format("one two three</p> <p>four five six seven")
    blocks = model.extract(page).split("\n\n")
    assert "one two three" in blocks and "four five six seven" in blocks


# Filters at every place of a text.


def test_filters_stand_at_every_place():
    rng = np.random.default_rng(0)
    net = quality.starting_model(rng)
    body = bytes(rng.integers(32, 127, 100).tolist())
    for shift in (0, 1, 2, 3):
        data = np.frombuffer(b" " * shift + body + bytes(400), np.uint8)
        view = np.lib.stride_tricks.sliding_window_view(net["embedding"][data], quality.WIDTH, axis=0)[: quality.CHUNK]
        plain = np.maximum((view.transpose(0, 2, 1).reshape(quality.CHUNK, -1) @ net["filters"]).max(axis=0), 0)
        found = quality.pooled(quality.chunked(b" " * shift + body), net)[0]
        assert np.allclose(found, plain, atol=1e-4)
