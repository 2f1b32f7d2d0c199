"""Held-out forms of pages: markup that no labelled page has, with word recall and precision."""

from __future__ import annotations

import re
from collections import Counter

import pytest

from caseload.llm.html_extract import Model
from caseload.llm.html_pages import labelled_pages

SENTENCES = (
    "Volunteers planted four hundred young oaks along the river bank on Saturday morning.",
    "The project had waited two years for a permit, and the first frost was near.",
    "Each tree carries a small number, so that pupils of the village school can follow its growth.",
    "According to the forester, one in ten will not see the spring.",
    "Those that do should shade the path by the time the pupils are grown.",
)
P = "".join(f"<p>{s}</p>" for s in SENTENCES)
ITEMS = "".join(f"<li>{s}</li>" for s in SENTENCES)

#: Page, with the article's words written as they are and all others in capitals.
FORMS = {
    "blog": f"<body class='single'><div class='site-nav'><ul><li><a href='/'>HOME</a></li><li><a href='/b'>BLOG</a></li></ul></div><main class='site-main'><article class='hentry'><h1 class='entry-title'>Oaks by the river</h1><div class='entry-meta'>POSTED BY ANN</div><div class='entry-content'>{P}</div></article></main><div class='widget-area'><h3>RECENT</h3><ul><li><a href='/1'>ONE</a></li><li><a href='/2'>TWO</a></li></ul></div><footer class='colophon'>PROUDLY POWERED</footer></body>",
    "news": f"<body><header class='page-header'><a class='logo' href='/'>THE HERALD</a><nav class='main-nav'><a href='/p'>POLITICS</a> <a href='/s'>SPORT</a></nav></header><div class='layout'><article class='story'><h1>Oaks by the river</h1><p class='lead'>{SENTENCES[0]}</p>{P}</article><aside class='rail'><h4>MOST READ</h4><ol><li><a href='/1'>FIRST STORY</a></li><li><a href='/2'>SECOND STORY</a></li></ol></aside></div><footer>COPYRIGHT HERALD</footer></body>",
    "wiki": f"<body><div id='mw-navigation'><ul><li><a href='/m'>MAIN PAGE</a></li><li><a href='/r'>RANDOM PAGE</a></li></ul></div><div id='content' class='mw-body'><h1 id='firstHeading'>Oaks by the river</h1><div class='mw-parser-output'>{P}<h2>Growth</h2><ul>{ITEMS}</ul></div></div><div id='footer'><ul><li>PRIVACY POLICY</li><li>ABOUT</li></ul></div></body>",
    "docs": f"<body><nav class='toc'><ul><li><a href='#a'>INSTALL</a></li><li><a href='#b'>USAGE</a></li></ul></nav><main><section><h1>Oaks by the river</h1>{P}<pre><code><span class='hl-k'>plant</span>(<span class='hl-n'>oak</span>, 400)</code></pre></section></main><footer><p>BUILT WITH DOCS</p></footer></body>",
    "meta first": f"<body><nav><a href='/'>HOME</a></nav><article><h1>Oaks by the river</h1><p class='intro meta-line'>{SENTENCES[3]}</p>{P}</article></body>",
    "bare": f"<body><h1>Oaks by the river</h1>{P}</body>",
    "table layout": f"<body><table><tr><td class='menu'><a href='/'>HOME</a><br><a href='/n'>NEWS</a></td><td class='main-cell'><h2>Oaks by the river</h2>{P}</td></tr></table></body>",
    "divs only": f"<body><div class='top menu'><a href='/'>HOME</a><a href='/c'>CONTACT</a></div><div class='middle'><h2>Oaks by the river</h2>{P}</div><div class='bottom footer'>ALL RIGHTS RESERVED</div></body>",
    "lists": f"<body><nav><a href='/'>HOME</a></nav><article><h1>Oaks by the river</h1><ol>{ITEMS}</ol><p>{SENTENCES[0]}</p></article><section class='comments'><h3>COMMENTS</h3><p>GREAT PIECE</p></section></body>",
    "quotes": f"<body><article><h1>Oaks by the river</h1><blockquote class='pullquote'><p>{SENTENCES[1]}</p></blockquote>{P}</article><div class='related-posts'><h3>RELATED</h3><a href='/1'>ANOTHER STORY</a></div></body>",
    "cookie bar": f"<body><div class='cookie-bar notice'><p>WE USE COOKIES ON THIS SITE</p><button>OK</button></div><main><h1>Oaks by the river</h1>{P}</main></body>",
    "newsletter": f"<body><article><h1>Oaks by the river</h1>{P}<div class='newsletter-box signup'><h4>GET OUR LETTER</h4><form><input name='e'><button>JOIN</button></form></div></article><footer>IMPRINT</footer></body>",
    "advert within": f"<body><main><article><h1>Oaks by the river</h1><p>{SENTENCES[0]}</p><div class='ad-slot advert'>ADVERTISEMENT BUY A SPADE</div>{P}</article></main></body>",
    "notes": f"<body><nav><a href='/'>HOME</a></nav><article><h1>Oaks by the river</h1>{P}<div class='notes'><p>{SENTENCES[2]}</p></div><section id='header-files'><p>{SENTENCES[4]}</p></section></article></body>",
    "figures": f"<body><article><h1>Oaks by the river</h1><figure class='media'><img src='o.jpg'><figcaption>{SENTENCES[0]}</figcaption></figure>{P}</article><aside><h3>MORE</h3><ul><li><a href='/1'>LINK ONE</a></li></ul></aside></body>",
    "script": f"<body><script>var x = 'SCRIPT';</script><style>.STYLE {{}}</style><article><h1>Oaks by the river</h1>{P}<script>track('SCRIPT')</script></article></body>",
    "breaks": f"<body><div class='navbar'><a href='/'>HOME</a></div><div class='content'><h1>Oaks by the river</h1>{'<br><br>'.join(SENTENCES)}</div></body>",
    "definition list": f"<body><main><h1>Oaks by the river</h1><dl><dt>Number</dt><dd>{SENTENCES[2]}</dd><dt>Loss</dt><dd>{SENTENCES[3]}</dd></dl>{P}</main><footer class='page-foot'>LEGAL NOTES</footer></body>",
    "thread": f"<body><article><h1>Oaks by the river</h1>{P}</article><div id='discussion' class='comment-thread'><div class='comment'><b>BOB</b><p>I WAS THERE TOO</p></div><div class='comment reply'><p>SO WAS MY DOG</p></div></div></body>",
    "breadcrumb": f"<body><ol class='breadcrumb-trail breadcrumb'><li><a href='/'>HOME</a></li><li><a href='/n'>NATURE</a></li></ol><article class='post-123 type-post'><h1>Oaks by the river</h1>{P}</article><nav class='post-navigation'><a href='/1'>OLDER</a> <a href='/2'>NEWER</a></nav></body>",
}


@pytest.fixture(scope="module")
def model():
    return Model(labelled_pages())


def words(text):
    return Counter(re.findall(r"\w+", text))


def expected(page):
    """All words of a page that are not in capitals."""
    plain = re.sub(r"<(script|style).*?</\1>", " ", page, flags=re.S)
    found = words(re.sub(r"<[^>]*>", " ", plain))
    return Counter({w: n for w, n in found.items() if not (w.isupper() and w != "A") or w.isdigit()})


def test_recall_and_precision_of_held_out_forms(model):
    right = wanted = given = 0
    for name, page in FORMS.items():
        found, should = words(model.extract(f"<html><head><title>T</title></head>{page}</html>")), expected(page)
        assert found, name
        right += sum((found & should).values())
        wanted, given = wanted + sum(should.values()), given + sum(found.values())
    assert len(FORMS) == 20
    assert right >= 0.98 * wanted and right >= 0.98 * given


def test_no_sentence_of_an_article_is_lost(model):
    for name, page in FORMS.items():
        text = model.extract(page)
        assert all(s in text for s in SENTENCES), name
