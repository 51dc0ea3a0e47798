"""Hostile and awkward pages, and pages made from random templates."""

from __future__ import annotations

import random
import time

import pytest

from signalstar.llm import wrappers


def host_texts(pages):
    """The pages of one host through its wrapper."""
    total = None
    for page in pages:
        own = wrappers.fold(wrappers.parse(page))
        total = own if total is None else wrappers.align(total, own)
    paths = wrappers.main_paths(total)
    return [wrappers.text_of(page, paths) for page in pages], paths, total


def test_deep_pages_beside_others(spark):
    deep = "<article>" + "<div>" * 1200 + "deep text" + "</div>" * 1200 + "<p>after it</p></article><footer>f</footer>"
    rows = [(1, "http://a.org/1", deep), (2, "http://a.org/2", "<article><p>flat</p></article>"),
            (3, "http://b.org/", "<b>" * 100_000 + "x" + "</b>" * 100_000 + "<div>y</div>")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r.text for r in wrappers.main_text(pages).collect()}
    assert got == {1: "deep text\n\nafter it", 2: "flat", 3: "x\n\ny"}


def test_side_parts_stay_closed_however_deep():
    page = "<div>" * 400 + "<nav>" + "<div>" * 5 + "menu" + "</div>" * 5 + "</nav>" + "kept" + "</div>" * 400
    assert wrappers.text_of(page, None) == "kept"


@pytest.mark.parametrize("piece", ["<a ", "<a x=", "<a x='", '<a "', "<!--", "<", "</", "<![CDATA[", "<p a=<"])
def test_hostile_markup_takes_linear_time(piece):
    begin = time.perf_counter()
    for end in ("", ">", "-->", "'>", '">'):
        wrappers.parse(piece * (1_000_000 // len(piece)) + end)
    assert time.perf_counter() - begin < 20


def test_quotes_in_attributes():
    page = "<article><p title=it's>Don't lose this.</p><p title='a > b' id=\"c > d\">Nor that.</p><p x='>y</p></article>"
    assert wrappers.text_of(page, None) == "Don't lose this.\n\nNor that.\n\ny"
    assert wrappers.text_of("<p>a</p><!-- open <p>b</p>", None) == "a"
    assert wrappers.text_of("a <b>c</b> < d", None) == "a c < d"


def test_pages_with_the_same_lead_keep_their_article():
    lead = "The same lead on every page. " * 20
    pages = [
        f"<div class=page><div class=byline>by author number {i}</div>"
        f"<div class=content><p>{lead}{'own words %d ' % i * 30}</p></div></div>"
        for i in range(4)
    ]
    texts, _, _ = host_texts(pages)
    assert all(f"own words {i}" in t and lead.strip() in t for i, t in enumerate(texts))


def test_site_header_without_an_article():
    pages = [f"<html><body><header>SITE NAME menu bar</header><p>first para {i}</p><p>second {i}</p></body></html>"
             for i in range(5)]
    assert host_texts(pages)[0] == [f"first para {i}\n\nsecond {i}" for i in range(5)]
    inside = "<body><main><header><h1>Title</h1></header><p>text</p></main></body>"
    assert wrappers.text_of(inside, None) == "Title\n\ntext"


def test_names_of_article_parts_are_not_those_of_side_parts():
    page = (
        "<article><h2 id='related-work'>Related work</h2><section id='social-impact'><p>Impact</p></section>"
        "<p class='notice-period'>Notice period</p><div class='search-results-table'>Results</div>"
        "<div class='comments with-avatars'>Nice!</div><div class='sidebar no-print'>Links</div>"
        "<div class='ad-slot-3'>Buy</div><ul class='share-buttons'><li>Share</li></ul>"
        "<div class=cookie_notice>Accept</div><div id=related-articles>More</div><p>End</p></article>"
    )
    assert wrappers.text_of(page, None).split("\n\n") == [
        "Related work", "Impact", "Notice period", "Results", "End"]


def test_slugs_do_not_grow_the_wrapper():
    pages = [f"<body><article id='post-{w}-of-the-day'><h2 id='{w}'>T</h2><p>{w}</p></article></body>"
             for w in ("".join(random.Random(i).choices("abcdefgh", k=9)) for i in range(60))]
    texts, paths, total = host_texts(pages)
    assert paths == [["body", "article"]]
    assert list(total["kids"]["body"]["kids"]) == ["article"]
    assert [t.split("\n\n")[0] for t in texts] == ["T"] * 60


SIDES = [
    "<nav><a href=/>Home</a></nav>", "<div class=sidebar><p>Links</p></div>", "<footer>(c)</footer>",
    "<header>Site</header>", "<div id=cookie-banner>Accept</div>", "<aside>Aside</aside>",
    "<form><input name=q></form>", "<script>if (a < b) x('</p>')</script>", "<div class='ad top'>Buy</div>",
    "<section id=comments><article class=comment><p>Nice</p></article></section>", "<style>p{}</style>",
]
WRAPS = [
    "<article>{}</article>", "<main>{}</main>", "<div class=content>{}</div>", "<div id=content><div>{}</div></div>",
    "<article class=post><div class=post-body>{}</div></article>",
]


@pytest.mark.parametrize("seed", range(25))
def test_planted_articles_are_found(seed):
    """Pages from a random template: what comes out is the article that was put in."""
    random_ = random.Random(seed)
    around = random_.choice(["{}", "<div class=page>{}</div>", "<div id=wrap><div class='has-sidebar'>{}</div></div>"])
    before = "".join(random_.sample(SIDES, random_.randrange(4)))
    after = "".join(random_.sample(SIDES, random_.randrange(4)))
    wrap = random_.choice(WRAPS)
    pages, wanted = [], []
    for page in range(8):
        blocks, html = [], []
        for k in range(random_.randrange(2, 6)):
            words = " ".join(random_.choices(["alpha", "beta", "it's", "gamma", "delta", "a<b"], k=25)) + f" {page} {k}"
            tag = random_.choice(["p", "h2", "li", "blockquote"])
            shown = words.replace("<", "&lt;")
            html.append(f"<ul><li>{shown}</ul>" if tag == "li" else f"<{tag}>{shown}</{tag}>")
            blocks.append(words)
            if random_.random() < 0.2:
                html.append(random_.choice(SIDES[:8]) if "article" in wrap else "")
                if "<header>" in html[-1]:
                    html.pop()
        pages.append(f"<html><head><title>t</title></head><body>{around.format(before + wrap.format(''.join(html)) + after)}")
        wanted.append("\n\n".join(blocks))
    assert host_texts(pages)[0] == wanted
