"""Main text of web pages by a tree-structured graphical model.

Every element and every piece of text of a page is a node that is content, is not, or holds both. A potential between
parent and child says how likely a child of that tag is content, given its parent; a potential at each
node weighs its names and its share of linked text. Messages go up the tree and down again
(sum-product), which gives each node's exact marginal. All potentials are counted from labelled pages.

Pages are parsed and scored in the map tasks; nothing is shuffled.
"""

from __future__ import annotations

from collections import Counter

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .rows import cells, column, field, row_key

#: Fixed values of HTML: elements without an end, with raw text, that are not shown, and that end a paragraph.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
UNSEEN = frozenset("head template noscript svg".split())
#: Raw text that is shown; that of the other raw elements is passed over with them.
SHOWN = frozenset(["textarea"])
#: What may stand in a head; anything else ends it, as its end tag is optional.
IN_HEAD = frozenset("title meta link script style base noscript template noframes basefont bgsound".split())
#: Elements of other languages, in which "/>" ends an element; tags that can't be in them and end them; and those of their elements that may hold such tags.
FOREIGN = ("svg", "math")
BREAKS = frozenset(
    """b big blockquote body br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 head hr i img li listing menu meta
    nobr ol p pre ruby s small span strong strike sub sup table tt u ul var""".split()
)
HOLDERS = ("foreignobject", "desc", "mi", "mo", "mn", "ms", "mtext", "annotation-xml")
BLOCK = frozenset(
    """address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption
    figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre
    search section select summary table tbody td textarea tfoot th thead tr ul button""".split()
)
#: An element that starts while one of these is open ends it, unless one of the others lies between.
CLOSES = {
    "li": (("li",), ("ul", "ol", "menu")),
    "dt": (("dt", "dd"), ("dl",)),
    "dd": (("dt", "dd"), ("dl",)),
    "tr": (("tr",), ("table",)),
    "td": (("td", "th"), ("tr", "table")),
    "th": (("td", "th"), ("tr", "table")),
    "option": (("option",), ("select",)),
}
TEXT = "#text"
#: Weight of the labelled pages' overall habits against those of one tag or name.
PRIOR = 2.0
#: A name on fewer elements than FEW counts as a name of its own.
FEW = 3
OWN_NAME = ("name", "")


#: States of a node: not content, content, and holding both.
STATES = (0, 1, 2)
CONTENT, HOLDS = 1, 2


def _shares(numbers: list[float]) -> list[float]:
    total = sum(numbers)
    return [x / total for x in numbers]


def tokens(html: str):
    """(kind, name, rest): start and end tags, and text; comments, declarations and raw text are passed over."""
    import re

    mark = re.compile(r"<(?:(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*\"|'[^']*')*+)>|(!--)|([!?/]))")
    place = foreign = 0
    while place < len(html):
        start = html.find("<", place)
        if start < 0:
            yield "text", "", html[place:]
            return
        if start > place:
            yield "text", "", html[place:start]
        found = mark.match(html, start)
        if found is None:
            if html[start + 1 : start + 2].isalpha():
                # A tag whose quotes don't end: up to the next bracket.
                end = html.find(">", start)
                place = len(html) if end < 0 else end + 1
            else:
                yield "text", "", "<"
                place = start + 1
        elif found[4]:
            end = html.find("-->", start + 4)
            place = len(html) if end < 0 else end + 3
        elif found[5]:
            end = html.find(">", start)
            place = len(html) if end < 0 else end + 1
        else:
            name, place = found[2].lower(), found.end()
            yield ("end" if found[1] else "start"), name, found[3]
            ended = found[3].endswith("/")
            if name in FOREIGN:
                foreign = max(0, foreign - 1) if found[1] else foreign + (not ended)
            if not found[1] and name in RAW and not (foreign and ended):
                closing = re.compile(f"</{re.escape(name)}(?=[\\s/>])", re.I).search(html, place)
                inside = html[place : closing.start() if closing else len(html)]
                if name in SHOWN:
                    yield "text", "", inside
                place = closing.start() if closing else len(html)


class Tree:
    """A page's nodes in page order: tag, parent, names, own text, and the block each text lies in."""

    def __init__(self, html: str):
        import html as entities
        import re

        attribute = re.compile(r"\b(class|id|role|y)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
        self.tag, self.parent, self.names, self.text, self.block = ["#page"], [-1], [()], [""], [0]
        self.label: list[int | None] = [None]
        # How many elements of each tag are open, so that none is looked for in vain.
        self.opened: Counter[str] = Counter()
        # The elements that are open in one that is not shown, which comes first.
        hidden: list[str] = []
        within: Counter[str] = Counter()
        # The block that has a blank before its next text.
        open_, block, blank = [0], 0, -1
        for kind, name, rest in tokens(html):
            if kind == "text":
                if hidden == ["head"] and not rest.isspace():
                    self._uncover(hidden, within, 0)
                if hidden:
                    continue
                if rest.isspace():
                    blank = block
                    continue
                said = entities.unescape(rest) if "&" in rest else rest
                self._add(TEXT, open_[-1], (), " " + said if blank == block else said, block)
                blank = -1
                continue
            if kind == "start":
                ended = rest.endswith("/")
                if hidden == ["head"] and name not in IN_HEAD:
                    self._uncover(hidden, within, 0)
                elif within["svg"] and name in BREAKS:
                    self._break_out(hidden, within)
                if name in RAW and name not in SHOWN:
                    continue
                if hidden or name in UNSEEN:
                    foreign = name in FOREIGN or within["svg"] or within["math"]
                    if name not in VOID and not (foreign and ended):
                        hidden.append(name)
                        within[name] += 1
                    continue
                if self.opened["math"] and name in BREAKS:
                    self._close(open_, ("math",), HOLDERS)
                if name in BLOCK:
                    block += 1
                    self._close(open_, ("p",), ("table", "td", "th", "button"))
                    if name in CLOSES:
                        self._close(open_, *CLOSES[name])
                if name == "br":
                    blank = block
                if name in VOID:
                    continue
                if ended and (name == "math" or self.opened["math"]):
                    continue
                names, label = (), None
                if "=" in rest:
                    words = []
                    for a in attribute.finditer(rest):
                        value = a[2] or a[3] or a[4] or ""
                        if a[1] == "y":
                            label = int(value) if value in ("0", "1", "2") else None
                        else:
                            words += re.findall(r"[a-z]+", re.sub(r"([a-z])([A-Z])", r"\1 \2", value).lower())
                    names = tuple(sorted(set(words)))
                open_.append(self._add(name, open_[-1], names, "", block, label))
                self.opened[name] += 1
            else:
                if hidden and not within[name] and self.opened[name]:
                    # The end of an element around it.
                    self._uncover(hidden, within, 0)
                if hidden:
                    if within[name]:
                        at = len(hidden) - 1
                        while hidden[at] != name:
                            at -= 1
                        self._uncover(hidden, within, at)
                    continue
                if name in BLOCK:
                    block += 1
                if self.opened[name]:
                    at = len(open_) - 1
                    while self.tag[open_[at]] != name:
                        at -= 1
                    self._cut(open_, at)

    def _add(self, tag, parent, names, text, block, label=None) -> int:
        self.tag.append(tag)
        self.parent.append(parent)
        self.names.append(names)
        self.text.append(text)
        self.block.append(block)
        self.label.append(label)
        return len(self.tag) - 1

    def _uncover(self, hidden: list[str], within: Counter[str], at: int) -> None:
        within.subtract(hidden[at:])
        del hidden[at:]

    def _break_out(self, hidden: list[str], within: Counter[str]) -> None:
        for at in range(len(hidden) - 1, -1, -1):
            if hidden[at] == "svg":
                self._uncover(hidden, within, at)
                return
            if hidden[at] in HOLDERS:
                return

    def _cut(self, open_: list[int], at: int) -> None:
        for node in open_[at:]:
            self.opened[self.tag[node]] -= 1
        del open_[at:]

    def _close(self, open_: list[int], ends: tuple[str, ...], but: tuple[str, ...]) -> None:
        if not any(self.opened[tag] for tag in ends):
            return
        for at in range(len(open_) - 1, 0, -1):
            tag = self.tag[open_[at]]
            if tag in ends:
                self._cut(open_, at)
                return
            if tag in but:
                return

    def features(self) -> list[tuple]:
        """What each node shows: its names or that it has none, and for blocks with text the share of it that is linked."""
        n = len(self.tag)
        size, linked, inside = [0] * n, [0] * n, [False] * n
        for i in range(1, n):
            inside[i] = inside[self.parent[i]] or self.tag[i] == "a"
            if self.tag[i] == TEXT:
                size[i] = len(self.text[i].strip())
                linked[i] = size[i] if inside[i] else 0
        for i in range(n - 1, 0, -1):
            size[self.parent[i]] += size[i]
            linked[self.parent[i]] += linked[i]
        out = []
        for i in range(n):
            found = [("name", w) for w in self.names[i]]
            if self.tag[i] != TEXT:
                found.append(("named", bool(found)))
            if size[i] and self.tag[i] in BLOCK:
                found.append(("links", min(3, int(4 * linked[i] / size[i]))))
            out.append(tuple(found))
        return out


class Model:
    """Potentials: `step[tag][state above][state]` and `shown[feature][state]`.

    A node is not content (0), content (1), or only holds both (2).
    """

    def __init__(self, pages: list[str]):
        steps, every, shown, kinds = Counter(), Counter(), Counter(), Counter()
        for page in pages:
            tree = Tree(page)
            label = [HOLDS]
            for i in range(1, len(tree.tag)):
                above = label[tree.parent[i]]
                label.append(above if tree.label[i] is None else tree.label[i])
                steps[tree.tag[i], above, label[i]] += 1
                every[above, label[i]] += 1
            for y, features in zip(label, tree.features(), strict=True):
                for f in features:
                    shown[f, y] += 1
                    kinds[f[0], y] += 1
        self.other = [_shares([every[a, y] + 1 for y in STATES]) for a in STATES]
        self.step = {
            tag: [_shares([steps[tag, a, y] + PRIOR * self.other[a][y] for y in STATES]) for a in STATES]
            for tag in {t for t, _, _ in steps}
        }
        # Names of few pages tell one thing together: that an element has a name of its own.
        few = {f for f, _ in shown if f[0] == "name" and sum(shown[f, y] for y in STATES) < FEW}
        for f in few:
            for y in STATES:
                shown[OWN_NAME, y] += shown.pop((f, y), 0)
        self.shown = {
            f: _shares([(shown[f, y] + 0.5) / (kinds[f[0], y] + 1) for y in STATES]) for f in {f for f, _ in shown}
        }

    def marginals(self, tree: Tree) -> list[float]:
        """The probability that each node is content: messages up to the root, then back.

        A message is scaled by its sum, which changes no marginal and keeps products in range.
        """
        n = len(tree.tag)
        known = []
        for features in tree.features():
            x = y = z = 1.0
            for f in features:
                if f[0] == "name" and f not in self.shown:
                    f = OWN_NAME
                if f in self.shown:
                    a, b, c = self.shown[f]
                    x, y, z = x * a, y * b, z * c
                    total = x + y + z
                    x, y, z = x / total, y / total, z / total
            known.append([x, y, z])
        steps = [self.step.get(t, self.other) for t in tree.tag]
        sent = [(1.0, 1.0, 1.0)] * n
        for i in range(n - 1, 0, -1):
            x, y, z = known[i]
            m = [r[0] * x + r[1] * y + r[2] * z for r in steps[i]]
            total = m[0] + m[1] + m[2]
            sent[i] = m = (m[0] / total, m[1] / total, m[2] / total)
            above = known[tree.parent[i]]
            x, y, z = above[0] * m[0], above[1] * m[1], above[2] * m[2]
            total = (x + y + z) or 1.0
            above[:] = x / total, y / total, z / total
        # The page itself only holds what is in it.
        down: list[tuple[float, float, float]] = [(0.0, 0.0, 1.0)] * n
        out = [0.0] * n
        for i in range(1, n):
            p = tree.parent[i]
            # What the parent knows without this child.
            x, y, z = (d * k / m for d, k, m in zip(down[p], known[p], sent[i], strict=True))
            a, b, c = steps[i]
            d = (x * a[0] + y * b[0] + z * c[0], x * a[1] + y * b[1] + z * c[1], x * a[2] + y * b[2] + z * c[2])
            total = sum(d) or 1.0
            down[i] = d = (d[0] / total, d[1] / total, d[2] / total)
            weights = [u * v for u, v in zip(d, known[i], strict=True)]
            out[i] = weights[CONTENT] / (sum(weights) or 1.0)
        return out

    def extract(self, html: str) -> str:
        """The texts that are likelier content than not, by block."""
        tree = Tree(html)
        blocks: dict[int, list[str]] = {}
        for tag, text, block, p in zip(tree.tag, tree.text, tree.block, self.marginals(tree), strict=True):
            if tag == TEXT and p >= 0.5:
                blocks.setdefault(block, []).append(text)
        joined = (" ".join("".join(parts).split()) for parts in blocks.values())
        return "\n\n".join(b for b in joined if b)


def main_texts(
    pages: DataFrame, model: Model, id_col: str = "page_id", url_col: str = "url", html_col: str = "html"
) -> DataFrame:
    """One row per row of `pages`: row_key, page_id, url, text, n_chars.

    A missing or empty page has the empty text. Missing ids and urls stay missing, repeated rows stay
    repeated, and an empty table gives no rows. Unclosed tags, comments and quotes end with the page.
    """
    rows = pages.select(
        row_key(pages).alias("row_key"),
        column(id_col).alias("page_id"),
        column(url_col).alias("url"),
        F.coalesce(column(html_col).cast("string"), F.lit("")).cast("binary").alias("body"),
    )

    def extracted(batches):
        import pyarrow as pa

        for batch in batches:
            texts = [model.extract(body.decode("utf-8", "replace")) for body in cells(batch, "body")]
            names = ("row_key", "page_id", "url")
            yield pa.RecordBatch.from_pydict(
                {
                    **{n: field(batch, n) for n in names},
                    "text": pa.array(texts, pa.string()),
                    "n_chars": pa.array([len(t) for t in texts], pa.int64()),
                }
            )

    kinds = {n: rows.schema[n].dataType.simpleString() for n in ("page_id", "url")}
    return rows.mapInArrow(
        extracted, f"row_key string, page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars bigint"
    )
