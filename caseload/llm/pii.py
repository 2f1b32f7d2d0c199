"""Personal data: fixed patterns, and spans found by bootstrapped contextual extraction.

Matches of the fixed patterns are the seeds. The one and two words before a seed are lexical patterns of
its kind. Candidates are looser shapes of the same kinds (a phone number without country code, an
obfuscated address, a card number that fails its check, a version-6 IP). Patterns and instances form a
graph that Spark scores in rounds: a pattern is as good as the share of its occurrences in the whole
corpus that known instances follow, candidates of unknown standing left aside; an instance is as good as
its patterns make it together. Good instances are known in the next round, and in the end candidates that
stand in a pattern good enough are spans too. Fixed matches always stay.

A pattern's occurrences are counted over whole texts. Which words to count is told by a bit map of fixed
size, so nothing that grows with the corpus is broadcast.
"""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .rows import cells, field, freeze, texts_of

KINDS = ("email", "ip", "card", "phone")

#: Distinct known instances and confidence that a pattern needs, and rounds of scoring.
MIN_INSTANCES = 3
CONFIDENCE = 0.8
ROUNDS = 3
#: Bits of the map of patterns to be counted (2 MB), and patterns counted in a task before they go on.
MAP_BITS = 1 << 24
HELD = 100_000
#: Code points looked back at first for the words before a span; more, if they don't hold two words.
BEFORE = 200

#: Marks that open what they stand before, and marks that end a word even where no white space follows.
OPENING = "<([{\"\u201c\u201e\u2018\u00ab"
GLUE = ":="
#: An apostrophe opens where a word may start.
QUOTE = re.compile(r"'(?<![^\s']')")

#: The base patterns. Digits of an IP start where no digit is before, which changes no match.
DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

#: Looser shapes of each kind.
LOOSE = {
    "email": re.compile(
        r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++ ?(?:\(at\)|\[at\]|\{at\}) ?"
        r"[A-Za-z0-9-]++(?: ?(?:\(dot\)|\[dot\]|\{dot\}|\.) ?[A-Za-z0-9-]++)+"
        r"|(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++ at [A-Za-z0-9-]++(?: dot [A-Za-z0-9-]++)+"
        r"|(?<![^\s<(\"'])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]{2,}+(?![.\w@-])"
    ),
    "ip": re.compile(r"(?<![0-9A-Za-z:])[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{0,4}){2,7}(?![0-9A-Za-z:])"),
}
#: Runs of digits and what may stand between those of a phone or card number.
DIGITS = re.compile(r"[0-9(). /-]{7,}+")


def _luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of every match of the base patterns that passes its check."""
    found, end = [], 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > end and LOCAL.match(text, start - 1):
            start -= 1
        domain = DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            found.append((start, 0, domain.end()))
            end = domain.end()
        at = text.find("@", max(at + 1, end))
    if any(d in text for d in "0123456789"):
        for m in IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m[0].split(".")):
                found.append((m.start(), 1, m.end()))
        for m in CARD.finditer(text):
            if m.end() - m.start() >= 14:
                digits = m[0].replace(" ", "").replace("-", "")
                if 14 <= len(digits) <= 19 and _luhn(digits):
                    found.append((m.start(), 2, m.end()))
        if "+" in text:
            for m in PHONE.finditer(text):
                if 10 <= sum(c.isdigit() for c in m[0]) <= 15:
                    found.append((m.start(), 3, m.end()))
    return sorted(found)


def digit_runs(text: str) -> list[tuple[int, int]]:
    """Of each run of digits and separators, the part from its first digit or bracket that no letter, digit,
    dot or plus stands before, to its last digit that no letter follows, if it has 7 characters at least."""
    found = []
    for m in DIGITS.finditer(text):
        start, end = m.span()
        while start < end and not ("0" <= text[start] <= "9" or text[start] == "(") or (
            start < end and start and (text[start - 1].isalnum() and text[start - 1].isascii() or text[start - 1] in ".+")
        ):
            start += 1
        if end < len(text) and text[end].isascii() and text[end].isalpha():
            # The last number belongs to what follows.
            while end > start and "0" <= text[end - 1] <= "9":
                end -= 1
        while end > start and not "0" <= text[end - 1] <= "9":
            end -= 1
        if end - start >= 7:
            found.append((start, end))
    return found


def candidates(text: str, taken: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of looser shapes that overlap no base span."""
    found = []
    if "@" in text or "at)" in text or "at]" in text or "at}" in text or " dot " in text:
        found += [(m.start(), 0, m.end()) for m in LOOSE["email"].finditer(text)]
    if any(d in text for d in "0123456789"):
        found += [(m.start(), 1, m.end()) for m in LOOSE["ip"].finditer(text)]
        for start, end in digit_runs(text):
            n = sum("0" <= text[i] <= "9" for i in range(start, end))
            if 7 <= n <= 15:
                found.append((start, 3, end))
            if 14 <= n <= 19:
                found.append((start, 2, end))
    free, i = [], 0
    for start, kind, end in sorted(found):
        while i < len(taken) and taken[i][2] <= start:
            i += 1
        # Base spans of different kinds may overlap, so a few more are looked at.
        if all(t[2] <= start or t[0] >= end for t in taken[max(0, i - 4) : i + 4]):
            free.append((start, kind, end))
    return free


def apart(text: str) -> str:
    """The text in small letters, with white space for opening marks and behind words that are glued to the next."""
    for mark in OPENING:
        text = text.replace(mark, " ")
    for mark in GLUE:
        text = text.replace(mark, mark + " ")
    if "'" in text:
        text = QUOTE.sub(" ", text)
    return text.lower()


def contexts(text: str, start: int) -> list[str]:
    """The lexical patterns before a place: one word, two words. None inside a word or at the start.

    Opening marks are passed over, and a word may be glued to what follows, as in 'tel:555'.
    """
    reach = BEFORE
    while True:
        begin = max(0, start - reach)
        before = apart(text[begin:start])
        if not before or not before[-1].isspace():
            return []
        words = before.split()
        if begin and not text[begin - 1].isspace():
            words = words[1:]
        if not begin or len(words) >= 2:
            return [" ".join(words[-n:]) for n in (1, 2) if len(words) >= n]
        reach *= 8


def slot(pattern: str) -> int:
    """A pattern's bit in the map."""
    import xxhash

    return xxhash.xxh3_64_intdigest(pattern.encode("utf-8", "replace")) % MAP_BITS


SPAN = "struct<start: int, kind: int, end: int, known: boolean, instance: string, patterns: array<string>>"


def spans_of(texts: DataFrame) -> DataFrame:
    """row_key, doc_id and the spans of each row: base ones (known) and candidates, with their patterns."""

    def rows(batches):
        import pyarrow as pa

        kind_of = pa.list_(
            pa.struct(
                [
                    ("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32()), ("known", pa.bool_()),
                    ("instance", pa.string()), ("patterns", pa.list_(pa.string())),
                ]
            )
        )
        for batch in batches:
            out = []
            for body in cells(batch, "body"):
                text = body.decode("utf-8", "replace")
                base = base_spans(text)
                out.append(
                    [
                        {
                            "start": s, "kind": k, "end": e, "known": known,
                            "instance": text[s:e].lower(), "patterns": contexts(text, s),
                        }
                        for known, found in ((True, base), (False, candidates(text, base)))
                        for s, k, e in found
                    ]
                )
            yield pa.RecordBatch.from_pydict(
                {"row_key": field(batch, "row_key"), "doc_id": field(batch, "doc_id"), "spans": pa.array(out, kind_of)}
            )

    id_type = texts.schema["doc_id"].dataType.simpleString()
    return texts.mapInArrow(rows, f"row_key string, doc_id {id_type}, spans array<{SPAN}>")


def bit_map(patterns: DataFrame) -> np.ndarray:
    """A map with the bit of each pattern set; of a fixed size, however many patterns there are."""

    def slots(batches):
        import pyarrow as pa

        for batch in batches:
            found = np.unique([slot(p) for p in batch.column(0).to_pylist()]).astype(np.int64)
            yield pa.RecordBatch.from_pydict({"word": pa.array(found >> 5), "bit": pa.array(1 << (found & 31))})

    words = patterns.mapInArrow(slots, "word bigint, bit bigint").groupBy("word").agg(F.bit_or("bit").alias("bits"))
    out = np.zeros(MAP_BITS // 32, np.uint32)
    # At most MAP_BITS / 32 rows.
    for r in words.collect():
        out[r["word"]] = r["bits"]
    return out


def occurrences(texts: DataFrame, patterns: DataFrame) -> DataFrame:
    """(pattern, n): how often words follow each of the patterns, over whole texts.

    Some other patterns that share a bit are counted too; they are dropped by whoever joins.
    """
    flags = texts.sparkSession.sparkContext.broadcast(bit_map(patterns))

    def rows(batches):
        from collections import Counter

        import pyarrow as pa

        bits, counted, wanted = flags.value, Counter(), {}

        def is_wanted(pattern: str) -> bool:
            known = wanted.get(pattern)
            if known is None:
                at = slot(pattern)
                known = bool(bits[at >> 5] >> np.uint32(at & 31) & np.uint32(1))
                if len(wanted) > HELD:
                    wanted.clear()
                wanted[pattern] = known
            return known

        def batch_of():
            return pa.RecordBatch.from_pydict(
                {"pattern": pa.array(counted.keys(), pa.string()), "n": pa.array(counted.values(), pa.int64())}
            )

        for batch in batches:
            for body in cells(batch, "body"):
                words = apart(body.decode("utf-8", "replace")).split()
                here = {w: n for w, n in Counter(words[:-1]).items() if is_wanted(w)}
                counted.update(here)
                if here:
                    # Two words are a wanted pattern only if the last one is.
                    pairs = Counter(f"{a} {b}" for a, b in zip(words, words[1:-1], strict=False) if b in here)
                    counted.update({p: n for p, n in pairs.items() if is_wanted(p)})
                if len(counted) > HELD:
                    yield batch_of()
                    counted.clear()
        if counted:
            yield batch_of()

    return texts.select("body").mapInArrow(rows, "pattern string, n bigint").groupBy("pattern").agg(F.sum("n").alias("n"))


def good_patterns(spans: DataFrame, texts: DataFrame) -> DataFrame:
    """(pattern, kind) of the patterns that are good enough after the rounds of scoring.

    `spans` has kind, known, instance and pattern. The occurrences that a kind's candidates of unknown
    standing follow are left out of the count.
    """
    edges = freeze(
        spans.groupBy("pattern", "kind", "instance")
        .agg(F.max("known").alias("seed"), F.count("*").alias("n"))
    )
    # Only patterns with enough instances of any standing can ever be good; those without a seed are learned in the rounds.
    frequent = edges.groupBy("pattern", "kind").agg(F.count("*").alias("instances"))
    frequent = freeze(frequent.where(F.col("instances") >= MIN_INSTANCES).select("pattern", "kind"))
    if frequent.isEmpty():
        return frequent
    counts = occurrences(texts, frequent.select("pattern").distinct()).withColumnRenamed("n", "total")
    counts = freeze(frequent.join(counts, "pattern"))
    edges = freeze(edges.join(counts, ["pattern", "kind"]))
    scored = edges.withColumn("score", F.col("seed").cast("double"))
    for number in range(ROUNDS):
        known = F.when(F.col("score") >= CONFIDENCE, F.col("n"))
        patterns = scored.groupBy("pattern", "kind", "total").agg(
            F.coalesce(F.sum(known), F.lit(0)).alias("hits"),
            F.count(known).alias("instances"),
            F.sum("n").alias("compatible"),
        )
        # Others than candidates follow the pattern so often; it needs as many occurrences to be judged.
        misses = F.greatest(F.lit(0), F.col("total") - F.col("compatible"))
        good = patterns.where(F.col("instances") >= MIN_INSTANCES).withColumn(
            "confidence", F.col("hits") / (F.col("hits") + misses + F.lit(0.5))
        )
        good = freeze(good.where(F.col("confidence") >= CONFIDENCE).select("pattern", "kind", "confidence"))
        if number == ROUNDS - 1 or good.isEmpty():
            return good.select("pattern", "kind")
        # An instance is wrong only if all its patterns are.
        instances = edges.join(good, ["pattern", "kind"]).groupBy("kind", "instance").agg(
            (1 - F.exp(F.sum(F.log(F.greatest(F.lit(1e-9), 1 - F.col("confidence")))))).alias("learned")
        )
        scored = edges.join(instances, ["kind", "instance"], "left").withColumn(
            "score", F.greatest(F.col("seed").cast("double"), F.coalesce("learned", F.lit(0.0)))
        )
        scored = freeze(scored)


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of `docs`: row_key, doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans.

    Counts and base_sha256 are of the base patterns; spans has the learned ones too. A missing or empty
    text has none. Ids may be missing or repeated. An empty table gives no rows.
    """
    texts = texts_of(docs, id_col, text_col)
    found = freeze(spans_of(texts))
    each = found.select("row_key", F.explode("spans").alias("s")).select("row_key", "s.*")
    lexical = each.select("kind", "known", "instance", F.explode("patterns").alias("pattern"))
    good = good_patterns(lexical, texts)
    # Patterns good for a kind accept its candidates wherever they stand.
    learned = (
        each.where(~F.col("known")).withColumn("pattern", F.explode("patterns"))
        .join(good, ["pattern", "kind"])
        .groupBy("row_key").agg(F.collect_set(F.struct("start", "kind", "end")).alias("learned"))
    )
    base = F.transform(F.filter("spans", lambda s: s["known"]), lambda s: F.struct(s["start"], s["kind"], s["end"]))
    names = F.array(*map(F.lit, KINDS))

    def written(spans):
        line = lambda s: F.concat_ws(":", names[s["kind"]], s["start"], s["end"])
        return F.array_join(F.transform(F.array_sort(spans), line), ",")

    rows = found.withColumn("base", base).drop("spans").join(learned, "row_key", "left")
    every = F.when(F.col("learned").isNull(), F.col("base")).otherwise(F.concat("base", "learned"))

    def count_of(kind: int):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{KINDS[kind]}")

    return rows.select(
        "row_key",
        "doc_id",
        *map(count_of, range(len(KINDS))),
        F.sha2(written(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        written(every).alias("spans"),
    )
