"""The classifier, shards, chats and pages."""

from __future__ import annotations

import html
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from caseload.llm import quality
from caseload.llm.chat import formatted_chats
from caseload.llm.html_extract import Model, Tree, main_texts
from caseload.llm.html_pages import labelled_pages
from caseload.llm.sharding import _hypergeometric, communication_matrix, shuffled_shards

import brute


def labelled(spark, n=400, seed=4):
    rng = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        good = rng.random() < 0.7
        words = ["".join(rng.choices("aeinorst", k=rng.randint(2, 9))) for _ in range(rng.choice([20, 80, 300]))]
        rows.append((i, " ".join(words) if good else " ".join(w + rng.choice(["###", "$$$"]) for w in words)))
        labels.append((i, int(good)))
    return (
        spark.createDataFrame([(*r, "x") for r in rows], "doc_id bigint, text string, body string"),
        spark.createDataFrame(labels, "doc_id bigint, quality int"),
        dict(labels),
    )


def test_held_out_rows_are_told_apart_and_never_learned_from(spark):
    docs, labels, known = labelled(spark)
    model = quality.trained(docs, labels)
    rows = quality.quality_scores(docs, model).collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in rows)
    held = [r for r in rows if r["held_out"]]
    assert len(held) > 100
    assert sum(r["predicted"] == known[r["doc_id"]] for r in held) > 0.97 * len(held)
    flipped = labels.withColumn(
        "quality", F.when(quality.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality"))
    )
    again = quality.trained(docs, flipped)
    assert all((model[k] == again[k]).all() for k in model)
    kept = quality.drop_low_quality(docs, model)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == {r["doc_id"] for r in rows if r["predicted"]}


def test_scores_of_awkward_rows(spark):
    docs = brute.awkward(spark)
    one_label = spark.createDataFrame([(1, 1), (2, 1), (2, None), (None, 0)], "doc_id bigint, quality int")
    for labels in (one_label, one_label.limit(0)):
        model = quality.trained(docs, labels)
        rows = quality.quality_scores(docs, model).collect()
        assert len(rows) == docs.count()
        assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in rows)
    assert quality.quality_scores(brute.empty(spark), model).count() == 0
    assert quality.drop_low_quality(docs, model).columns == docs.columns


def test_every_place_of_a_document_is_under_a_filter():
    model = quality.starting_model(np.random.default_rng(0))
    body = bytes(np.random.default_rng(1).integers(1, 256, 1000).astype(np.uint8))
    pooled = quality.pooled(quality.chunked(body), model).max(axis=0)
    padded = np.frombuffer(body + bytes(24 + quality.REACH), np.uint8)
    places = [model["embedding"][padded[p : p + quality.WIDTH]].reshape(-1) for p in range(1024)]
    whole = np.maximum((np.array(places) @ model["filters"]).max(axis=0) + model["shift"], 0)
    assert np.allclose(pooled, whole, atol=1e-5)
    # Texts scored together don't change each other.
    alone = [quality.scores_of([t], model)[0] for t in (body, b"", b"abc")]
    assert np.allclose(quality.scores_of([body, b"", b"abc"], model), alone, atol=1e-6)


def test_the_accuracy_on_the_held_out_rows_of_the_table(spark):
    from caseload.llm.queries import QUERIES

    rows = QUERIES["op7_quality_classifier"][0](spark, "/root/testdata/sf0.01")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    held = rows.where("held_out").join(labels, "doc_id").collect()
    assert sum(r["predicted"] == r["quality"] for r in held) >= 0.93 * len(held)


def test_the_matrix_has_exact_margins():
    counts = [0, 5, 1, 1000, 17, 3]
    for seed in range(20):
        matrix = communication_matrix(counts, 7, seed)
        assert matrix.min() >= 0
        assert matrix.sum(axis=1).tolist() == counts
        sizes = matrix.sum(axis=0)
        assert sizes.max() - sizes.min() <= 1
    assert communication_matrix([], 4, 0).shape == (0, 4)
    rng = np.random.default_rng(0)
    drawn = [_hypergeometric(rng, 2 * 10**9, 2 * 10**9, 1000) for _ in range(50)]
    assert 450 < np.mean(drawn) < 550


def test_shards_have_exact_sizes_and_gapless_slots(spark):
    docs = brute.awkward(spark, [f"text {i}" for i in range(300)]).repartition(7)
    rows = shuffled_shards(docs, shards=16, cell_rows=5).collect()
    expected = Counter(
        (i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in brute.ids_and_texts(docs)
    )
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in rows) == expected
    sizes = Counter(r["shard"] for r in rows)
    assert set(sizes) == set(range(16))
    assert max(sizes.values()) - min(sizes.values()) <= 1
    for s, n in sizes.items():
        assert sorted(r["slot"] for r in rows if r["shard"] == s) == list(range(n))
    assert {(r["law"], r["grown_shard"]) for r in rows} == {("rows", None)}
    assert shuffled_shards(brute.empty(spark)).count() == 0


def test_a_shuffle_is_uniform_and_the_same_again(spark):
    docs = spark.range(0, 64, 1, 3).selectExpr("id AS doc_id", "'x' AS text")
    places = Counter()
    for seed in range(12):
        rows = shuffled_shards(docs, shards=4, seed=seed).collect()
        for r in rows:
            places[r["doc_id"] // 16, r["shard"]] += 1
    # 12 shuffles of 16 ids a group over 4 shards: 48 expected each.
    assert all(20 < places[g, s] < 80 for g in range(4) for s in range(4))
    again = {(r["doc_id"], r["shard"], r["slot"]) for r in shuffled_shards(docs, shards=4, seed=11).collect()}
    assert again == {(r["doc_id"], r["shard"], r["slot"]) for r in rows}


def chat_rows(spark, rows):
    return spark.createDataFrame([(*r, "k") for r in rows], "conv_id bigint, turn bigint, role string, text string, conv string")


def test_chats_are_those_of_brute_force(spark):
    rng = random.Random(6)
    rows = []
    for c in range(60):
        first = rng.choice(["hello", "hi", None, ""])
        turns = [first, *(rng.choice(["a", "b"]) for _ in range(rng.randrange(5)))]
        start = rng.choice([0, 3])
        rows += [(c, start + t, ("user", "assistant", None)[t % 2], text) for t, text in enumerate(turns)]
    rows += rows[:20]
    rows += [(None, 0, "user", "lost"), (None, None, "user", "x"), (70, None, "user", "no number"), (70, 1, None, None)]
    found = {}
    for r in formatted_chats(chat_rows(spark, rows)).orderBy("conv_id", "part").collect():
        text = found.get(r["conv_id"], (0, 0, ""))[2] + r["text"]
        found[r["conv_id"]] = (r["n_turns"], r["copies"], text)
    assert found == brute.chats(rows)
    assert formatted_chats(chat_rows(spark, rows).limit(0)).count() == 0


def test_long_chats_come_in_parts(spark):
    long = [(1, t, "user", f"turn {t}") for t in range(1000)]
    shorter = [(2, t, "user", f"turn {t}") for t in range(700)]
    other = [(3, t, "user", f"turn {t if t < 600 else -t}") for t in range(650)]
    rows = formatted_chats(chat_rows(spark, [*long, *shorter, *other])).orderBy("conv_id", "part").collect()
    assert Counter(r["conv_id"] for r in rows) == {1: 4, 3: 3}
    text = "".join(r["text"] for r in rows if r["conv_id"] == 1)
    assert text == "".join(f"<|im_start|>user\nturn {t}<|im_end|>\n" for t in range(1000))


def test_no_part_has_more_turns_than_a_range(spark):
    # All turns without a number, a number with many texts, and one with the first of them; and one with gaps.
    lost = [(None, None, "user", f"lost {i}") for i in range(1000)]
    same = [(5, 3, "user", f"said {i}") for i in range(600)] + [(5, 4, "assistant", "b")]
    first = [(6, 3, "user", t) for t in sorted(f"said {i}" for i in range(600))[:300]]
    gaps = [(7, t, "user", f"turn {t}") for t in range(200, 300)]
    rows = [*lost, *same, *first, *gaps, *lost[:50], *same[:50]]
    parts = formatted_chats(chat_rows(spark, rows)).orderBy("conv_id", "part", "piece").collect()
    assert max(r["text"].count("<|im_start|>") for r in parts) == 256
    found = {}
    for r in parts:
        text = found.get(r["conv_id"], (0, 0, ""))[2] + r["text"]
        found[r["conv_id"]] = (r["n_turns"], r["copies"], text)
    assert found == brute.chats(rows)
    assert set(found) == {None, 5, 7}
    assert [(r["part"], r["piece"]) for r in parts] == [
        *((-1, i) for i in range(4)), *((0, i) for i in range(3)), (0, 0), (1, 0),
    ]


@pytest.fixture(scope="module")
def model():
    return Model(labelled_pages())


PAGES = {
    '<body><header><h1>Site</h1></header><div id="sidebar"><p>Side.</p></div><main><h2>T</h2><p>Body.</p></main>'
    "<footer>f</footer></body>": "T\n\nBody.",
    '<body><article><div class="cookie-notice"><p>We use cookies.</p></div><h1>T</h1><p>Body.</p>'
    '<section class="comments"><p>Nice!</p></section></article></body>': "T\n\nBody.",
    '<body><article><h1>T</h1><p>Body &lt;b&gt; &amp; c&nbsp;d.</p></article><div id="comments">'
    '<div class="comment"><p>Great post indeed.</p></div></div></body>': "T\n\nBody <b> & c d.",
    "<article><h1>T</h1><p>One</p><aside>Side note</aside><p>Two</p><form><input><button>Go</button>Mail</form></article>": (
        "T\n\nOne\n\nTwo"
    ),
    '<div class="advert-box">Buy</div><div class="content"><p>x</p><ul><li>a</li><li>b</li></ul><div class="ad">Buy</div>'
    '<p>y <a href=z>link</a> z</p></div><div class="site-footer">c</div>': "x\n\na\n\nb\n\ny link z",
    '<article><noscript>no</noscript><p>b</p><script>var a="<p>x</p>"</script><style>p{}</style><!-- c <p>no</p> -->'
    "<p>c</p></article>": "b\n\nc",
    "<article><p>a <b>bold<br><p>c\n\n d</p></article>": "a bold\n\nc d",
    "<article><table><tr><td>1<td>2<tr><td>3</table><p>1 < 2 & 3 > 2</p></article>": "1\n\n2\n\n3\n\n1 < 2 & 3 > 2",
    "<body><p>Just a paragraph.</p><p>Another.</p></body>": "Just a paragraph.\n\nAnother.",
    '<article><p title="a > b">x</p><p class="unclosed>y</p></article>': "x\n\ny",
    "": "",
    "<": "",
    "<!-- never closed <p>x</p>": "",
    "<nav><ul><li><a href='/'>Home</a></li></ul></nav>": "",
}

#: Elements that are not shown and whose ends are missing or in the start tag; and ones that are shown.
UNENDED = {
    "<html><head><title>t</title><body><article><p>Body.</p></article></body></html>": "Body.",
    "<html><head><meta charset=x><noscript><link href=x></noscript><article><p>Body.</p></article></html>": "Body.",
    "<html><head><title>t</title><style>p{}</style></head><body><article><p>Body.</p></article></body></html>": "Body.",
    "<article><p>a</p><svg class='i'/><p>b <math/>c</p></article>": "a\n\nb c",
    "<article><p>a</p><svg><style/><title/><path d='M0'/><text>x</text></svg><p>b</p></article>": "a\n\nb",
    "<article><p>a</p><svg><path d='M0'><p>b</p></article>": "a\n\nb",
    "<article><p>a</p><svg><foreignObject><p>x</p></foreignObject></svg><p>b</p></article>": "a\n\nb",
    "<article><p>a</p><div><noscript><p>x</p><div>y</div></div><p>b</p></article>": "a\n\nb",
    "<article><p>a</p><div><template><b>x</b></div><p>b</p></article>": "a\n\nb",
    "<article><p>a</p><object data='x'><param name=n><p>b</p></article>": "a\n\nb",
    "<article><p>a</p><object data='x'><p>b</p></object><p>c</p></article>": "a\n\nb\n\nc",
    "<article><p>So <math><mi>x</mi><mspace/><mo>=</mo><mn>2</mn></math> holds.</p><p>b</p></article>": "So x=2 holds.\n\nb",
    "<article><p>a</p><math><mi>x<p>b</p></article>": "a\n\nx\n\nb",
    "<article><noscript><svg/><noscript>x</noscript></noscript><p>a</p></article>": "a",
}


@pytest.mark.parametrize("page", PAGES)
def test_the_text_of_pages(model, page):
    assert model.extract(page) == PAGES[page]


@pytest.mark.parametrize("page", UNENDED)
def test_what_is_not_shown_ends_with_what_is_around_it(model, page):
    assert model.extract(page) == UNENDED[page]


def test_marginals_are_those_of_all_labellings(model):
    """Sum-product against the sum over every labelling of a small tree."""
    from itertools import product
    from math import prod

    tree = Tree('<div class="content"><p>a</p></div><aside class="ad">b</aside>')
    n = len(tree.tag)
    shown = [[prod(model.shown.get(f, [1 / 3] * 3)[y] for f in fs) for y in range(3)] for fs in tree.features()]
    total, content = 0.0, [0.0] * n
    for states in product(range(3), repeat=n - 1):
        y = (2, *states)
        weight = prod(
            model.step.get(tree.tag[i], model.other)[y[tree.parent[i]]][y[i]] * shown[i][y[i]] for i in range(1, n)
        )
        total += weight
        for i in range(1, n):
            content[i] += weight * (y[i] == 1)
    assert np.allclose(model.marginals(tree)[1:], [c / total for c in content[1:]])


def test_labelled_pages_are_learned(model):
    right = wrong = 0
    for page in labelled_pages():
        tree = Tree(page)
        label = [2]
        for i in range(1, len(tree.tag)):
            label.append(label[tree.parent[i]] if tree.label[i] is None else tree.label[i])
        for tag, y, p in zip(tree.tag, label, model.marginals(tree), strict=True):
            if tag == "#text":
                right += (p >= 0.5) == (y == 1)
                wrong += (p >= 0.5) != (y == 1)
    assert right > 0.96 * (right + wrong)


def test_deep_and_long_pages_end(model):
    deep = "<div>" * 20_000 + "x" + "</div>" * 20_000
    assert isinstance(model.extract(deep), str)
    many = "<article>" + "<p>word</p>" * 50_000 + "</article>"
    assert model.extract(many).count("word") == 50_000


def article(page):
    """The blocks of a page of the table, whose article is marked and nothing else."""
    inside = page[page.index("<article>") : page.index("</article>")]
    blocks = (re.sub(r"<[^>]+>", "", b.replace("<br>", " ")) for b in re.split(r"</?(?:p|h1|article)\b[^>]*>", inside))
    return "\n\n".join(b for b in (" ".join(html.unescape(b).split()) for b in blocks) if b)


def test_the_pages_of_the_table(spark, model):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    texts = {r["page_id"]: r["html"] for r in pages.collect()}
    rows = main_texts(pages, model).collect()
    assert {r["page_id"]: r["text"] for r in rows} == {i: article(t) for i, t in texts.items()}
    assert all(r["n_chars"] == len(r["text"]) for r in rows)
    odd = spark.createDataFrame([(None, None, None, "x"), (1, "u", "", "x"), (1, "u", "", "x")], "page_id bigint, url string, html string, text string")
    assert Counter(tuple(r)[1:] for r in main_texts(odd, model).collect()) == {(None, None, "", 0): 1, (1, "u", "", 0): 2}
    assert main_texts(odd.limit(0), model).count() == 0
