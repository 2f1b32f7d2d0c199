"""Labelled pages that train the content model.

`y="1"` marks an element of the article, `y="0"` one that is not, and `y="2"` one that only holds both; an
element without a mark has its parent's. Pages vary in what carries the article, in what surrounds it, and in how these are named.
"""

from __future__ import annotations

import re

TEXT = (
    "The committee met on Tuesday and agreed on a plan for the coming year, which will be published soon.",
    "Prices rose in most regions, although the pace was slower than in the months before.",
    "Short note.",
    "No.",
    "A reader who follows the argument to its end will find that the two accounts agree on every point that matters.",
)
LINKS = '<ul><li><a href="/">Home</a></li><li><a href="/news">News</a></li><li><a href="/about">About</a></li></ul>'
LINE = '<a href="/x">More</a> | <a href="/y">Contact</a> | <a href="/z">Imprint</a>'

#: What carries the article: opening and closing markup.
ARTICLES = (
    ("<article>", "</article>"),
    ("<main><article>", "</article></main>"),
    ('<main id="main">', "</main>"),
    ('<main y="2"><div class="container row" y="2"><article>', "</article></div></main>"),
    ('<div class="content">', "</div>"),
    ('<div id="content"><div class="post">', "</div></div>"),
    ('<div class="article-body">', "</div>"),
    ('<div class="entry-content">', "</div>"),
    ('<section class="story text">', "</section>"),
    ('<article class="post"><header><h1>A title of some length</h1></header>', "</article>"),
    ('<div role="main"><div class="article">', "</div></div>"),
    ("<div><div>", "</div></div>"),
    ("<div>", "</div>"),
    ("<section>", "</section>"),
    # Nothing carries it: the elements of the inside are marked themselves.
    ("", ""),
    ("", ""),
)

#: The inside of an article.
BODIES = (
    "<h1>Title</h1><p>{0}</p><p>{2}</p><p>{1} <a href='/a'>A source</a> says so.</p><p>{3}</p>",
    "<h1>On a plan</h1><p><b>{0}<br><p>{4}</p><h2>Part</h2><p>{1}</p><p><em>{2}</em></p>",
    "<p>{4}</p><blockquote>{1}</blockquote><ul><li>{0}</li><li>{2}</li></ul><p>{3}</p><pre>x = 1</pre>",
    "<h2>Figures</h2><table><tr><th>Year</th><th>Rate</th></tr><tr><td>2001</td><td>3.5</td></tr></table><p>{0}</p>",
    "<figure><img src='i.png'><figcaption>{2}</figcaption></figure><p>{1}</p><ol><li>{4}</li></ol><p>{3}</p>",
    "{0}<br>{1}<br>{4}",
    "<div><p>{0} <span>{2}</span></p></div><div><p>{1}</p><h3>{3}</h3><p><i>{4}</i></p></div>",
    "<p>{3}</p><p>{2}</p><p>{3}</p><p>{2}</p>",
    "<h2>Sources</h2><p><a href='/a'>{2}</a></p><p>{1}</p><ul><li><a href='/b'>{3}</a> {2}</li><li>{0}</li></ul>",
    "<p>{2} <a href='/a'>{4}</a></p><p>{3}</p><p><a href='/c'>{3}</a> and <a href='/d'>{2}</a></p>",
)

#: What may stand before, after or inside the article. The names are common ones of the web.
MENUS = (
    f"<nav y='0'>{LINKS}</nav>",
    f"<div class='nav navbar menu' y='0'>{LINKS}</div>",
    f"<div id='menu' class='top-menu navigation' y='0'>{LINE}</div>",
    f"<ol class='breadcrumb breadcrumbs' y='0'>{LINE}</ol>",
    f"<ul role='navigation' class='menu nav pagination pager' y='0'><li>{LINE}</li></ul>",
)
HEADERS = (
    f"<header y='0'><a href='/'>The Daily</a>{LINKS}</header>",
    "<header class='site-header masthead' y='0'><h1>The Daily</h1><p>News since 1901</p></header>",
    "<div id='header' class='header banner' role='banner' y='0'><h2>The Daily</h2><p>News and more.</p></div>",
    "<div class='topbar masthead' y='0'><span>Tuesday</span> <a href='/l'>Log in</a></div>",
)
FOOTERS = (
    f"<footer y='0'>&copy; example.com &middot; {TEXT[1]}</footer>",
    "<footer class='site-footer' y='0'><p>&copy; 2020 The Daily. All rights reserved.</p></footer>",
    f"<div id='footer' class='footer bottom' role='contentinfo' y='0'><p>{TEXT[0]}</p>{LINE}</div>",
    f"<div class='copyright colophon legal' y='0'><small>&copy; The Daily</small>{LINE}</div>",
)
SIDES = (
    f"<aside y='0'><h3>Related</h3>{LINKS}<p>{TEXT[1]}</p></aside>",
    f"<div class='sidebar widget' y='0'><h3>Popular</h3><p>{TEXT[0]}</p>{LINKS}</div>",
    f"<div id='sidebar' class='side related recommended' role='complementary' y='0'><p>{TEXT[4]}</p></div>",
    f"<section class='widget related more trending' y='0'><h2>Read next</h2>{LINKS}</section>",
    "<div class='share social sharing' y='0'><a href='/f'>Share</a> <a href='/t'>Post</a></div>",
    "<div class='tags meta byline' y='0'>Filed under <a href='/p'>Plans</a></div>",
)
NOTICES = (
    f"<div class='cookie consent notice' y='0'><p>This site uses cookies. {TEXT[0]}</p><button>Accept</button></div>",
    f"<div id='cookie' class='cookies gdpr banner' y='0'>{TEXT[1]}</div>",
    f"<div class='notice alert message' role='alert' y='0'><p>{TEXT[0]}</p></div>",
    f"<dialog class='popup modal overlay' y='0'><p>{TEXT[1]}</p><button>Close</button></dialog>",
    f"<div class='newsletter subscribe signup' y='0'><p>{TEXT[0]}</p></div>",
    f"<p class='notice disclaimer cookie' y='0'>{TEXT[4]}</p>",
)
ADVERTS = (
    f"<div class='ad' y='0'>{TEXT[0]}</div>",
    f"<div class='ads advert advertisement' y='0'><p>{TEXT[1]}</p></div>",
    f"<div id='ad' class='sponsored promo promoted' y='0'><a href='/buy'>{TEXT[4]}</a></div>",
    f"<section class='ad sponsor banner' y='0'><p>{TEXT[0]}</p><p>{TEXT[2]}</p></section>",
    f"<aside class='promo ad' y='0'>{TEXT[1]}</aside>",
    f"<p class='ad advert sponsored' y='0'>{TEXT[4]}</p>",
)
FORMS = (
    "<form y='0'><label>Search</label><input name='q'><button>Go</button></form>",
    f"<form class='search login' y='0'><p>{TEXT[0]}</p><select><option>One</option><option>Two</option></select></form>",
    "<div class='search form login' y='0'><label>Name</label><textarea>Text</textarea><button>Send</button></div>",
)
COMMENTS = (
    f"<section class='comments' id='comments' y='0'><h3>Comments</h3><p>{TEXT[4]}</p><p>{TEXT[2]}</p></section>",
    f"<div id='comments' class='comment discussion' y='0'><div class='comment'><b>Ann</b><p>{TEXT[0]}</p></div></div>",
    f"<ol class='comments commentlist replies' y='0'><li class='comment reply'><p>{TEXT[1]}</p></li></ol>",
    f"<div class='respond reply reviews' id='disqus' y='0'><p>{TEXT[0]}</p></div>",
    f"<article class='comment' y='0'><p>{TEXT[1]}</p></article>",
)

AROUND = (MENUS, HEADERS, FOOTERS, SIDES, NOTICES, ADVERTS, FORMS, COMMENTS)


#: How often each article meets each inside, among other surroundings each time.
ROUNDS = 6


#: Names of what is no article, in the order of the alphabet.
NAMES = sorted(
    {
        word
        for kind in AROUND
        for form in kind
        for value in re.findall(r"(?:class|id|role)='([^']*)'", form)
        for word in value.split()
    }
)


def spelled(number: int) -> str:
    """A word that no other number gives."""
    word = "q"
    while number:
        number, last = divmod(number, 26)
        word += chr(97 + last)
    return word


def misnamed(inside: str, turn: int) -> str:
    """An element of an article with a name of what is no article, every second time beside a word of its own."""
    name = NAMES[turn // 8 % len(NAMES)]
    if turn // 8 % 2:
        name = f"{name}-{spelled(turn)}"
    places = [m.end() - 1 for m in re.finditer(r"<(?:p|div|h2|ul|span|blockquote|pre|table)>", inside)]
    if not places:
        return f"<p class='{name}'>{inside}</p>"
    at = places[turn // 8 % len(places)]
    return f"{inside[:at]} class='{name}'{inside[at:]}"


def coloured(turn: int) -> str:
    """A program, whose words have names for their colours."""
    words = ("def", "run", "(", "x", "):", "return", "x")
    said = " ".join(f"<span class='{spelled(turn * 8 + i)}'>{w}</span>" for i, w in enumerate(words))
    return f"<pre><code>{said}</code></pre>"


def labelled_pages() -> list[str]:
    """Every article with every inside, each among other surroundings; some of them lie inside it.

    In one page of eight an element of the article is named like what is none, in another one the article
    holds a program; in one of four, parts around it have a name of their own.
    """
    pages, turn = [], 0
    for opening, closing in ARTICLES * ROUNDS:
        for body in BODIES:
            turn += 1
            # Each kind goes through its forms at its own pace.
            parts = [kind[(turn * (i + 1) + turn // (7 + i)) % len(kind)] for i, kind in enumerate(AROUND)]
            inside = body.format(*TEXT)
            if turn % 8 == 1:
                inside = misnamed(inside, turn)
            elif turn % 8 == 5:
                inside += coloured(turn)
            if turn % 4 == 3:
                for own in (turn // 4 % len(parts), (turn // 4 + 3) % len(parts)):
                    parts[own] = parts[own].replace("class='", f"class='{spelled(turn)}-", 1)
            if opening:
                first = opening.index(">", opening.rindex("<") if "y=" in opening else 0)
                marked = f'{opening[:first]} y="1"{opening[first:]}{inside}'
            else:
                marked = re.sub(r"<(\w+)", r'<\1 y="1"', inside if inside[0] == "<" else f"<p>{inside}</p>")
            if turn % 2 == 0:
                marked += parts[(0, 2, 3, 4, 5, 6, 7)[turn // 2 % 7]]
            before = "".join(parts[i] for i in (1, 0, 4, 5) if (turn >> i) % 3 != 1)
            after = "".join(parts[i] for i in (3, 6, 7, 2) if (turn >> (i % 4)) % 4 != 3)
            wrap = ("", "") if turn % 2 else ('<div class="wrapper container" y="2">', "</div>")
            pages.append(
                f'<html y="2"><body><!-- page -->{wrap[0]}{before}{marked}{closing}{after}{wrap[1]}</body></html>'
            )
    return pages
