import random

import pytest

from tillbook.llm.html import ASIDE_WORDS, extract_text, main_text

LONG = "The quick brown fox, they say, jumps over the lazy dog, and then it sleeps."
TALK = "I really liked this, thank you, and I will come back to read some more of it."
BEFORE = '<!DOCTYPE html><html><head><title>No</title><style>p{a:b}</style></head><body class="has-sidebar">'
ASIDES = [
    "<nav><ul><li><a href=/>Home</a></li></ul></nav>",
    '<div id="main-menu"><a href="/a">Menu, one, two, three, four, five, six</a></div>',
    f"<header><h1>Site name</h1><p>{TALK}</p></header>",
    f"<footer>&copy; 2020, all rights reserved. {TALK}</footer>",
    f'<aside><p>{TALK}</p></aside><div class="sidebar"><p>{TALK}</p></div>',
    f'<div class="cookie-notice">{TALK}</div><div role="alert">{TALK}</div>',
    f'<div class="ad">{TALK}</div><div class="adBanner">{TALK}</div>',
    f"<form><p>{TALK}</p><textarea>x</textarea><button>Send, now</button></form>",
    f"<script>var a='<p>{TALK}</p>';</script><noscript>{TALK}</noscript>",
    f'<div class="comments"><p>{TALK}</p></div><section id="comment-list"><article class="comment"><p>{TALK}</p></article></section>',
    f'<div style="display: none"><p>{TALK}</p></div><p hidden>{TALK}</p>',
]
BODIES = [
    (f"<article><h1>Title</h1><p>{LONG}</p><p>Short.</p><ul><li>one</li><li>two</li></ul></article>", ["Title", LONG, "Short.", "one", "two"]),
    (f'<main><div class="post-body"><h2>Title</h2><p>{LONG}<p>{LONG}</div></main>', ["Title", LONG, LONG]),
    (f'<div class="content"><p>{LONG}</p><blockquote>{LONG}</blockquote><p>End &amp; all.</p></div>', [LONG, LONG, "End & all."]),
    (f"<div><div><p>{LONG}</p></div><div><p>{LONG} Again.</p></div></div>", [LONG, f"{LONG} Again."]),
    (f"<article><header><h1>Title</h1><p>by X</p></header><p>{LONG}</p><footer>tags</footer></article>", ["Title", LONG]),
    (f"<article><p><b>{LONG}<br><p>{LONG}</p><p>a<br>b</p></article>", [LONG, LONG, "a b"]),
    ("<article><h1>Title</h1><p>Tiny.</p></article>", ["Title", "Tiny."]),
    (f'<div class="content-with-sidebar"><h2>T</h2><p>{LONG}</p><div class="post-footer">x, y</div></div>', ["T", LONG]),
]


@pytest.mark.parametrize("body, blocks", BODIES)
@pytest.mark.parametrize("aside", range(len(ASIDES)))
def test_article_without_what_is_beside_it(body, blocks, aside):
    expected = "\n".join(blocks)
    assert main_text(f"{BEFORE}{ASIDES[aside]}{body}</body></html>") == expected
    assert main_text(f"{BEFORE}{body}{ASIDES[aside]}") == expected


@pytest.mark.parametrize("attributes", [
    'style="overflow:hidden"', 'title="a hidden valley"', 'data-of="hidden"', "data-style='display:none'", "aria-hidden=false",
    "style='display:none; display:block'", "data-x='aria-hidden=\"true\" hidden'", "data-to='/the/hidden/valley'", 'data-x="class=sidebar"',
])
def test_words_in_values_do_not_hide(attributes):
    body = f'<h1>Title</h1><p>{LONG} <a href="/the/hidden/valley">Go on.</a></p><p>Short.</p>'
    expected = "\n".join(["Title", f"{LONG} Go on.", "Short."])
    assert main_text(f"{BEFORE}<article {attributes}>{body}</article>") == expected
    assert main_text(f"{BEFORE}<div {attributes}><div class='content'>{body}</div></div>") == expected


@pytest.mark.parametrize("attributes", [
    "hidden", "HIDDEN", 'hidden=""', "class=x hidden", "aria-hidden=true", "ARIA-HIDDEN = 'true'", "style=display:none",
    'style="color:red; Display : None !important"', "style='visibility:hidden'", "style='visibility: hidden;'", "title='a' hidden/",
])
def test_hidden_parts(attributes):
    assert main_text(f"{BEFORE}<article><p>{LONG}</p><div {attributes}><p>{TALK}</p></div></article>") == LONG


@pytest.mark.parametrize("open_tag, close_tag", [
    ("<article>", "</article>"), ("<main>", "</main>"), ('<div class="content">', "</div>"), ("<main><article>", "</article></main>"),
])
def test_long_articles_keep_what_short_ones_keep(open_tag, close_tag):
    rest = "<pre>a = 1</pre><ul><li>one</li><li>two</li></ul><table><tr><td>x<td>1</table><figure><figcaption>Fig. 1</figcaption></figure>"
    for n in (1, 5, 13, 14, 40, 300):
        page = f"{BEFORE}{ASIDES[1]}{open_tag}<ul><li>zero</li></ul><div>{f'<p>{LONG}</p>' * n}</div>{rest}<div>Short end</div>{close_tag}{ASIDES[5]}"
        assert main_text(page) == "\n".join(["zero", *[LONG] * n, "a = 1", "one", "two", "x 1", "Fig. 1", "Short end"])


def test_all_at_once():
    body, blocks = BODIES[0]
    half = len(ASIDES) // 2
    assert main_text(BEFORE + "".join(ASIDES[:half]) + body + "".join(ASIDES[half:])) == "\n".join(blocks)


@pytest.mark.parametrize("source, text", [
    (None, ""), ("", ""), ("<html></html>", ""), ("plain &lt;b&gt; &eacute;&#233; &copy", "plain <b> éé ©"),
    ("<p>cut <a href='x", "cut"), ("<p>a &nbsp; \n b", "a b"), ("1 < 2 and 3 > 2", "1 < 2 and 3 > 2"),
    ("<article><table><tr><td>a<td>b<tr><td>c</table></article>", "a b\nc"), ("<!-- x --><p>y<!-- z", "y"),
    ("<p>&#0;&#xD800;&bogus;", "��&bogus;"),
])
def test_small_pages(source, text):
    assert main_text(source) == text


def test_large_pages_take_linear_time():
    for unit in ("<div>", "<b><p>", "</p>", "<a href=\"", "<!--", "<", "<script>", "&amp;", "<td>", "<li>", "x"):
        main_text(unit * 60_000)


@pytest.mark.parametrize("quote", ["'", '"'])
def test_long_attribute_values(quote):
    value = "<svg><path d=M0></svg> " * 10_000
    page = f"<article><p data-x={quote}{value}{quote}>{LONG}</p><div data-x={quote}{value}{quote} class=sidebar><p>{TALK}</p></div></article>"
    assert main_text(page) == LONG


def test_quotes_that_do_not_close_take_linear_time():
    for unit in ('<a b=">" ', "<a b='>' ", "<a b=\"'>\" ", '<a b=">"'):
        for last in ("", "<a c='", '<a c="'):
            main_text(unit * 60_000 + last)


def test_table_of_pages(spark):
    rows = [(1, "u", "<p>One, two.</p>", 5), (1, "u", "<p>One, two.</p>", 5), (2, None, None, 6), (None, "v", "", 7)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, n_chars int").repartition(2)
    found = extract_text(pages)
    assert sorted(tuple(r) for r in found.select("text", "n_chars").collect()) == [("", 0), ("", 0), ("One, two.", 9), ("One, two.", 9)]
    assert found.columns.count("n_chars") == 1
    assert extract_text(pages.limit(0)).count() == 0


SMALL_BLOCK = f"<div><p>{TALK}</p></div>"


@pytest.mark.parametrize("opening, closing", [
    ('<article class="post-12 post category-social">', "</article>"), ('<main><article class="post tag-search">', "</article></main>"),
    ('<article class="cookie-recipe">', "</article>"), ('<div id="content" class="content sidebar-right">', "</div>"),
    ('<div id="story" class="story login-required">', "</div>"), ('<div class="main-content no-comments">', "</div>"),
    ('<section class="entry sidebar-left">', "</section>"), ('<div class="post has-sidebar">', "</div>"),
    *[(f'<article class="post {name}-{word}">', "</article>") for word in sorted(ASIDE_WORDS) for name in ("tag", "category")],
    *[(f'<article class="{name}-{word}">', "</article>") for word in sorted(ASIDE_WORDS) for name in ("tag", "category")],
])
def test_names_of_subjects_and_layout_do_not_lose_the_article(opening, closing):
    page = f"{BEFORE}{ASIDES[1]}{opening}<h1>Title</h1>{f'<p>{LONG}</p>' * 3}<p>Short.</p>{closing}{ASIDES[9]}<footer>{TALK}</footer>"
    assert main_text(page) == "\n".join(["Title", *[LONG] * 3, "Short."])


@pytest.mark.parametrize("name", ["wrapper sidebar-left", "page-banner-on", "layout-widget-free"])
def test_a_layout_that_holds_all_is_read_by_its_points(name):
    page = f'{BEFORE}{ASIDES[1]}<div class="{name}"><div><h2>T</h2>{f"<p>{LONG}</p>" * 9}</div></div>{SMALL_BLOCK}'
    assert main_text(page).startswith("\n".join(["T", *[LONG] * 9]))


@pytest.mark.parametrize("part", [
    '<article class="comment byuser">', '<div class="comment-list">', '<div class="site-comments">', '<div id="comments" class="content">',
    '<section class="widget widget-area">', '<div class="mobile-nav-bar">', '<div class="site-sidebar">', '<article class="sidebar">',
])
def test_parts_beside_the_article_go_by_name(part):
    end = part[1:].split()[0]
    page = f"{BEFORE}<article><p>{LONG}</p><p>{LONG}</p></article>{part}{f'<p>{TALK}</p>' * 2}</{end}>"
    assert main_text(page) == f"{LONG}\n{LONG}"
    inside = f"{BEFORE}<article><p>{LONG}</p>{part}<p>{TALK}</p></{end}><p>{LONG}</p></article>"
    assert main_text(inside) == f"{LONG}\n{LONG}"


def _tree(rng, depth, chosen):
    """A random page with its article's blocks, told by construction: asides are clearly named, the article is <article>."""
    aside = rng.choice(["nav", 'div class="sidebar"', 'section id="comments"', "footer", 'div class="cookie-notice"'])
    tag = aside.split()[0]
    extra = f"<{aside}><p>{TALK}</p></{tag}>" if rng.random() < 0.7 else ""
    if not depth:
        blocks = [f"{LONG} {rng.randrange(1000)}." for _ in range(rng.randint(1, 5))]
        chosen += blocks
        names = rng.choice(["", ' class="post tag-widget"', ' class="hentry sidebar-off entry"', ' id="post-3"'])
        inner = "".join(f"<p>{b}</p>{extra if rng.random() < 0.2 else ''}" for b in blocks)
        return f"<article{names}>{inner}</article>"
    inside = _tree(rng, depth - 1, chosen)
    wrap = rng.choice(["div", 'div class="content sidebar-right"', "main", 'section id="story" class="story login-required"'])
    return f"<{wrap}>{extra if rng.random() < 0.5 else ''}{inside}{extra}</{wrap.split()[0]}>"


def test_random_small_trees():
    rng = random.Random(4)
    for _ in range(300):
        chosen = []
        page = _tree(rng, rng.randint(0, 3), chosen)
        assert main_text(f"{BEFORE}{page}</body></html>") == "\n".join(chosen), page
