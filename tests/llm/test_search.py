"""Personal data, decontamination and licences against brute force."""

from __future__ import annotations

import random
import textwrap
from collections import Counter

import pytest

from caseload.llm.decontaminate import contamination, drop_contaminated
from caseload.llm.licenses import TEMPLATES, THRESHOLD, license_scan, statements, words_of
from caseload.llm.pii import base_spans, personal_data

import brute

PRIVATE = (
    "mail a.b+c@d-e.example.com, and x@y or @z.com or a@@b.co a@b.c@d.e",
    "ip 1.2.3.4 and 256.1.1.1 and 1.2.3.4.5.6.7.8 and 01.002.3.255 11.22.33.",
    "card 4111 1111 1111 1111 and 4111-1111-1111-1112 and 4111  1111 5500005555555559 12345678901234567890",
    "call +1 (017) 555-7713 or +49.30.123456 or +1 2 or +1 234 567 8901 234 567 ++1 (234) 567-8901",
    "ä+4915112345678é 10.0.0.1@a.bc 1.1.1.1 +1.2.3.4.5.6.7.8.9.0.1",
)


@pytest.mark.parametrize("text", [*PRIVATE, "", "9" * 5000, "a" * 3000 + "@", "+1" + " " * 3000])
def test_base_spans_are_those_of_the_patterns(text):
    names = ("email", "ip", "card", "phone")
    assert ",".join(f"{names[k]}:{s}:{e}" for s, k, e in base_spans(text)) == brute.personal(text)


def test_long_runs_are_searched_in_linear_time():
    import time

    from caseload.llm.pii import candidates

    began = time.process_time()
    for text in ("a" * 300_000 + " x@y", "1" * 300_000 + " x@y", "+1" * 100_000, "(at)" * 50_000, "1:" * 100_000):
        candidates(text, base_spans(text))
    assert time.process_time() - began < 20


def test_personal_data_of_awkward_rows(spark):
    docs = brute.awkward(spark, PRIVATE)
    found = personal_data(docs).collect()
    assert Counter((r.doc_id, r.spans) for r in found) == Counter(
        (i, brute.personal(t)) for i, t in brute.ids_and_texts(docs)
    )
    for r in found:
        kinds = Counter(s.split(":")[0] for s in r.spans.split(",") if s)
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(kinds[k] for k in ("email", "ip", "card", "phone"))
    assert personal_data(brute.empty(spark)).count() == 0


def test_contexts_of_known_entities_find_unseen_ones(spark):
    seen = [f"please call our office phone: +1 (55{i}) 555-010{i} for help, contact: jo{i}@example.com now" for i in range(6)]
    unseen = [f"please call our office phone: 555 010 12{i}4 for help, contact: jo{i} (at) example (dot) com now" for i in range(4)]
    other = [f"the serial 555 010 12{i} is no number of anyone, meet at noon." for i in range(4)]
    docs = brute.awkward(spark, [*seen, *unseen, *other])
    found = {r.doc_id: r.spans for r in personal_data(docs).collect()}
    for n, text in enumerate(seen):
        assert found[100 + n] == brute.personal(text)
    for n, text in enumerate(unseen, len(seen)):
        phone, mail = text.index("555 010"), text.index("jo")
        assert found[100 + n] == f"phone:{phone}:{phone + 12},email:{mail}:{text.index(' now')}"
    for n in range(len(seen) + len(unseen), len(seen) + len(unseen) + len(other)):
        assert found[100 + n] == ""


def test_instances_of_a_round_teach_new_contexts(spark):
    seeds = [f"office phone: +1 (55{i}) 555-010{i} for help" for i in range(6)]
    learned = [f"office phone: 555 010 12{i}4 for help" for i in range(4)]
    # No base match stands behind these words: they are known by the numbers above only.
    again = [f"or reach me at 555 010 12{i}4 for help" for i in range(4)]
    unseen = [f"or reach me at 555 777 98{i}3 for help" for i in range(3)]
    docs = brute.awkward(spark, [*seeds, *learned, *again, *unseen])
    found = {r.doc_id: r.spans for r in personal_data(docs).collect()}
    for n, text in enumerate([*learned, *again, *unseen], len(seeds)):
        start = text.index("555")
        assert found[100 + n] == f"phone:{start}:{start + 12}"


def test_words_before_opening_and_glued_marks(spark):
    from caseload.llm.pii import apart, contexts

    for text, words in {
        "write to <jo@x.org>": ["to", "write to"],
        "(ask) Tel:555": ["tel:", "ask) tel:"],
        "see (\"'555": ["see"],
        "a mail='jo": ["mail=", "a mail="],
        "don't555": [],
        "<555": [],
    }.items():
        start = max(text.rfind("555"), text.rfind("jo"))
        assert contexts(text, start) == words
        # The same words are counted over whole texts.
        assert apart(text).split()[: len(words)] == (words[-1].split() if words else apart(text).split()[:0])
    seeds = [f"to <jo{i}@example.com> or tel:+1 (55{i}) 555-010{i} now" for i in range(6)]
    unseen = [f"to <ann{i} (at) example (dot) com> or tel:555-010-12{i}4 now" for i in range(4)]
    docs = brute.awkward(spark, [*seeds, *unseen])
    found = {r.doc_id: r.spans for r in personal_data(docs).collect()}
    for n, text in enumerate(unseen, len(seeds)):
        mail, phone = text.index("ann"), text.index("555")
        assert found[100 + n] == f"email:{mail}:{text.index('>')},phone:{phone}:{phone + 12}"


def contaminated_table(spark, seed=2):
    rng = random.Random(seed)
    words = ["the", "of", "a", "an", "longer-word", "extraordinarily", "é", "naïveté", "X1", "in", "on"]
    items = [(i, " ".join(rng.choices(words, k=rng.choice([0, 1, 4, 10, 11, 40])))) for i in range(40)]
    items += [(40, None), (41, "..."), (None, "an item without id that has more than ten words in it, really"), (5, "again five")]
    texts = []
    for _ in range(60):
        body = rng.choices([*words, "unknown", "zzz"], k=rng.choice([0, 5, 50, 300]))
        for _ in range(rng.choice([0, 1, 3])):
            quote = (rng.choice(items)[1] or "").split()
            at = rng.randrange(len(body) + 1)
            body[at:at] = quote[rng.randrange(3) :]
        texts.append(rng.choice([" ", ", ", "\n"]).join(body))
    benchmark = spark.createDataFrame([(*r, "x") for r in items], "item_id bigint, text string, body string")
    return brute.awkward(spark, texts), benchmark, items


def hit_rows(df):
    return Counter(tuple(r)[:6] for r in df.collect())


def test_contamination_is_that_of_brute_force(spark):
    docs, benchmark, items = contaminated_table(spark)
    found = contamination(docs, benchmark)
    expected = brute.contamination(brute.ids_and_texts(docs), items)
    assert hit_rows(found) == Counter(expected)
    for r in found.collect():
        assert sum(s["to"] - s["from"] for s in r["spans"]) == r["n_hit"]
        assert (r["longest"] > 0) == r["contaminated"]
    kept = drop_contaminated(docs, benchmark)
    assert kept.columns == docs.columns
    assert Counter(r["doc_id"] for r in kept.collect()) == Counter(r[0] for r in expected if not r[5])


def test_a_benchmark_in_blocks_gives_the_same(spark):
    docs, benchmark, _ = contaminated_table(spark, seed=8)
    whole = contamination(docs, benchmark)
    assert hit_rows(contamination(docs, benchmark, block_bytes=800)) == hit_rows(whole)
    kept = drop_contaminated(docs, benchmark, block_bytes=800)
    assert Counter(r["doc_id"] for r in kept.collect()) == Counter(
        r["doc_id"] for r in drop_contaminated(docs, benchmark).collect()
    )


def test_shards_of_any_size_give_the_same(spark, monkeypatch):
    import caseload.llm.decontaminate as decontaminate

    docs, benchmark, _ = contaminated_table(spark, seed=9)
    whole = hit_rows(contamination(docs, benchmark))
    monkeypatch.setattr(decontaminate, "SHARD_BYTES", 50)
    assert hit_rows(contamination(docs, benchmark)) == whole


def test_the_longest_match_reaches_beyond_the_window(spark):
    quote = "one two three four five six seven eight nine ten eleven twelve thirteen"
    docs = spark.createDataFrame([(1, f"before {quote} after"), (2, quote[4:60])], "doc_id bigint, text string")
    benchmark = spark.createDataFrame([(7, f"zero {quote} last"), (8, quote[8:])], "item_id bigint, text string")
    found = {r["doc_id"]: r for r in contamination(docs, benchmark).collect()}
    assert (found[1]["longest"], found[1]["n_hit"], found[1]["item_ids"]) == (13, 13, ["7", "8"])
    assert [tuple(s) for s in found[1]["spans"]] == [(1, 14)]
    assert found[2]["longest"] == 10


def test_empty_tables_have_no_hits(spark):
    docs, benchmark, _ = contaminated_table(spark)
    assert contamination(brute.empty(spark), benchmark).count() == 0
    assert contamination(docs, benchmark.limit(0)).where("contaminated or n_items > 0").count() == 0
    assert drop_contaminated(docs, benchmark.limit(0)).count() == docs.count()


def licensed(spark):
    mit = next(t for n, t in TEMPLATES if t.startswith("Permission"))
    rows = [
        ("a/LICENSE", f"Copyright (c) 2020\n\n{mit}\n\nMore words."),
        ("a/b/c/main.py", "no statement here"),
        ("a/b/COPYING.txt", "Licensed under CC BY-NC 4.0."),
        ("a/b/other.py", "# Licensed under the Apache License, Version 2.0.\ncode"),
        ("a/b2/file.py", None),
        ("a/b/LICENSE", "nothing that is known"),
        ("/d/x.py", "All rights reserved."),
        ("d/y.py", "the word license alone is no statement of anything that we know about this file"),
        ("top.py", ""),
        (None, "Released under the MIT License."),
        (None, "x"),
        ("a/b/c/main.py", "no statement here"),
    ]
    return spark.createDataFrame([(*r, "k", 1.0) for r in rows], "path string, text string, row_key string, score double"), rows


def test_licences_are_inherited_from_the_nearest_directory(spark):
    files, _ = licensed(spark)
    found = Counter((r.path, r.own_license, r.license, r.license_dir) for r in license_scan(files, "path", "text").collect())
    assert found == Counter(
        [
            ("a/LICENSE", "MIT", "MIT", None),
            ("a/b/c/main.py", None, "CC-BY-NC-4.0", "a/b"),
            ("a/b/c/main.py", None, "CC-BY-NC-4.0", "a/b"),
            ("a/b/COPYING.txt", "CC-BY-NC-4.0", "CC-BY-NC-4.0", None),
            ("a/b/other.py", "Apache-2.0", "Apache-2.0", None),
            ("a/b2/file.py", None, "MIT", "a"),
            ("a/b/LICENSE", None, "CC-BY-NC-4.0", "a/b"),
            ("d/x.py", "proprietary", "proprietary", None),
            ("d/y.py", None, None, None),
            ("top.py", None, None, None),
            (None, "MIT", "MIT", None),
            (None, None, None, None),
        ]
    )
    assert license_scan(files.limit(0), "path", "text").count() == 0


def test_scores_are_those_of_brute_force(spark):
    files, rows = licensed(spark)
    said = [statements(t or "") for _, t in rows]
    expected = brute.cosine_licenses(said, [(n, words_of(t)) for n, t in TEMPLATES], THRESHOLD)
    found = license_scan(files, "path", "text")
    assert Counter((r.own_license, r.score) for r in found.collect()) == Counter(expected)


def test_wrapped_and_commented_licences_are_known(spark):
    import textwrap

    from caseload.llm.licenses import _gnu

    def wrapped(text, width=70, mark=""):
        return "\n".join(mark + line for line in textwrap.wrap(text, width))

    mit = max((t for n, t in TEMPLATES if n == "MIT"), key=len).removeprefix("MIT License ")
    first, rest = mit.split(" The above", 1)
    mit = f"{wrapped(first)}\n\n{wrapped('The above' + rest)}"
    apache = max((t for n, t in TEMPLATES if n == "Apache-2.0"), key=len)
    gnu = {name: _gnu(*of) for name, *of in (("GPL-3.0", "General Public License", "3"), ("GPL-2.0", "General Public License", "2"))}
    rows = [
        ("m/LICENSE", f"Copyright (c) 2020 Jo Doe\n\n{mit}\n", "MIT"),
        ("m/a/main.c", "int main;", "MIT"),
        ("c/mit.js", "/*\n" + textwrap.indent(f"Copyright (c) 2020 Jo Doe\n\n{mit}", " * ", lambda _: True) + "\n */\nf();", "MIT"),
        ("c/apache.py", f"#!/usr/bin/python\n{wrapped(apache, 60, '# ')}\n\nimport os", "Apache-2.0"),
        ("c/gpl.cc", f"{wrapped(gnu['GPL-3.0'][1], 60, '// ')}\nint x;", "GPL-3.0"),
        ("c/gpl2.cc", f"{wrapped(gnu['GPL-2.0'][1], 60, '// ')}\nint x;", "GPL-2.0"),
        ("g/COPYING", "    GNU GENERAL PUBLIC LICENSE\n       Version 3, 29 June 2007\n\n Everyone may copy it.", "GPL-3.0"),
        ("n/none.txt", "Of the license\nwe know nothing.", None),
    ]
    files = spark.createDataFrame(rows, "path string, text string, expected string")
    found = {r.path: r.license for r in license_scan(files, "path", "text").collect()}
    assert found == {path: name for path, _, name in rows}


def test_licences_that_are_much_alike(spark):
    from caseload.llm import licenses as known

    holder = "Copyright (c) 2020, Jo Doe and others. All rights reserved.\n\n"
    lgpl = known._gnu("Lesser General Public License", "2.1")[1]
    files = {
        "a/LICENSE": (holder + known._BSD_TERMS + "\n\n" + known._BSD_END, "BSD-2-Clause"),
        "b/LICENSE": (holder + known._BSD_TERMS + "\n\n" + known._BSD_NAMES + "\n\n" + known._BSD_END, "BSD-3-Clause"),
        "c/LICENSE": (holder + known._ISC_GRANT + ", " + known._ISC_NOTICE + "\n\n" + known._ISC_END, "ISC"),
        "d/LICENSE": (holder + known._ISC_GRANT + ".\n\n" + known._ISC_END, "0BSD"),
        "e/LICENSE": (f"Boost Software License - Version 1.0\n\n{known._BOOST_GRANT}\n\n{known._BOOST_END}", "BSL-1.0"),
        "f/LICENSE": (holder + known._ZLIB, "Zlib"),
        "g/LICENSE": (holder + known._template("MIT", "Permission") + "\n\n" + known._MIT_END, "MIT"),
        "h/a.c": ("/* " + holder.strip() + "\n *\n * " + lgpl.replace(". ", ".\n * ") + "\n */\nint x;", "LGPL-2.1"),
        "g/b.c": ("// Copyright 2020 Jo Doe\n// All rights reserved.\nint x;", "proprietary"),
        "i/a.py": ("# SPDX-License-Identifier: GPL-3.0-only\n" + "x = 1\n", "GPL-3.0-only"),
        "i/b.py": ("# SPDX-License-Identifier: LGPL-2.1-only\n# All rights reserved.\n", "LGPL-2.1-only"),
        "i/c.py": ("// SPDX-License-Identifier: (MIT OR Apache-2.0)\n", "MIT OR Apache-2.0"),
        "i/d.py": ("# SPDX-License-Identifier: BSD-2-Clause\n# Licensed under the MIT License.\n", "BSD-2-Clause"),
        "i/e.py": (known._template("EPL-2.0", "This program"), "EPL-2.0"),
        "i/f.py": ("no word of it", None),
    }
    # The same again, wrapped and in comments.
    wrapped = {f"w/{p}": ("".join(f" * {line}\n" for line in textwrap.wrap(t, 70)), n) for p, (t, n) in files.items() if "LICENSE" in p}
    rows = [(p, t) for p, (t, _) in {**files, **wrapped}.items()]
    df = spark.createDataFrame(rows, "path string, text string")
    found = {r.path: r.own_license for r in known.license_scan(df, "path", "text").collect()}
    assert found == {p: n for p, (_, n) in {**files, **wrapped}.items()}
    # Reserved rights in the tree of a licence change nothing.
    (inside,) = known.license_scan(df, "path", "text").where("path = 'g/b.c'").collect()
    assert (inside.own_license, inside.license, inside.license_dir, inside.inherited) == ("proprietary", "MIT", "g", True)
