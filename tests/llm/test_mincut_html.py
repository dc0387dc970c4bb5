"""Operator 7: extraction from pages of several builds, the cut against brute force."""

import itertools
import random

from sluice.llm.mincut_html import FlowGraph, content_score, extract_main_text, main_blocks, main_text, text_blocks

SITE = """<html><head><title>x</title><style>p{}</style></head><body class="home has-sidebar">
<div id="cookie-notice">We use cookies. <button>OK</button></div><header><h2>Site Name</h2><a href=/>Home</a></header>
<div class="breadcrumbs"><a href=/>Home</a> &gt; <a href=/b>News</a></div>
%s<h1>Great &amp; news&nbsp;today</h1><p>First <b>para</b>graph with some   words and a <a href=x>link</a>.<br>second line<p>Short.
<div class="ad">Buy now!</div><ul><li>One item here</li><li>Two<ul><li>nested</li></ul></ul><blockquote>A quote.</blockquote>
<form><label>Mail</label><input><p>Subscribe to our list today please</p></form>%s
<aside class="sidebar"><h3>Related</h3><p>Another article is here with a long text in a paragraph for you to read now.</p></aside>
<section id="comments"><h3>2 comments</h3><div class="comment"><p>I like this text a lot, it is well written and true.</p></div></section>
<footer>&copy; 2020 The Site</footer><script>if (a<b) document.write("<p>x</p>")</script></body></html>"""
MAIN = "Great & news today\nFirst paragraph with some words and a link. second line\nShort.\nOne item here\nTwo\nnested\nA quote."


def test_main_text_of_several_builds():
    for opening, closing in (("<article>", "</article>"), ("<main>", "</main>"), ('<div class="post-content">', "</div>"),
                             ('<div role="main">', "</div>"), ('<div id="content">', "</div>"), ("<div>", "</div>"), ("<article>", "")):
        page = SITE % (opening, closing)
        if closing or opening != "<article>":
            assert main_text(page) == MAIN, opening
        else:  # never closed: what stands after it keeps its own marks
            assert main_text(page) == MAIN


def test_article_header_and_nested_boilerplate():
    page = """<body><nav><a href=1>Alpha</a> <a href=2>Beta</a></nav><article><header><h1>Title here</h1></header><p>Some text of the article.</p>
    <div class="share-buttons"><a href=1>Share</a></div><p>More text of it.</p><section class="comments"><p>Nice article, thank you!</p></section>
    </article><aside><article><h2>Other story</h2><p>Teaser text of the other story.</p></article></aside><div class="newsletter">Join us.</div></body>"""
    assert main_text(page) == "Title here\nSome text of the article.\nMore text of it."


def test_broken_pages():
    for page, text in (("", ""), ("plain text only", "plain text only"), ("<p>a<p>b</p></p>", "a\nb"), ("</div></p>text", "text"),
                       ("<b><i>x</b>y</i>", "xy"), ("&amp;&#x41;&bogus;", "&A&bogus;"), ("<!-- x", ""), ("<script>abc", ""),
                       ("<table><tr><td>a<td>b<tr><td>c</table>", "a\nb\nc"), ("<div>" * 3000 + "deep", "deep"), ("<p>1 < 2</p>", "1 < 2")):
        assert main_text(page) == text, page


def test_minimum_cut_equals_brute_force():
    r = random.Random(1)
    for _ in range(200):
        n = r.randrange(1, 7)
        ends = [(r.randrange(9), r.randrange(9)) for _ in range(n)]
        sides = {(i, j): r.randrange(6) for i in range(n) for j in range(i) if r.random() < 0.6}
        g = FlowGraph(n + 2)
        for i, (a, b) in enumerate(ends):
            g.add(n, i, a)
            g.add(i, n + 1, b)
        for (i, j), w in sides.items():
            g.add(i, j, w, w)

        def cost(x):
            return sum(b if k else a for k, (a, b) in zip(x, ends)) + sum(w for (i, j), w in sides.items() if x[i] != x[j])

        got = g.source_side(n, n + 1)[:n]
        assert cost(got) == min(map(cost, itertools.product([False, True], repeat=n)))


def test_long_pages_are_whole():
    page = "<article>" + "".join(f"<p>Paragraph number {i} of a very long page.</p>" for i in range(5000)) + "</article>"
    assert main_text(page).count("\n") == 4999


def test_rows(spark):
    rows = [(1, "u", SITE % ("<main>", "</main>"), "x", 1), (2, None, None, "x", 1), (None, "v", "", "x", 1), (3, "w", "<p>é &eacute;</p>", "x", 1)]
    df = spark.createDataFrame(rows + rows[:1], "page_id bigint, url string, html string, text string, n_chars int")
    got = sorted(map(tuple, extract_main_text(df).collect()), key=repr)
    want = [(1, "u", MAIN, len(MAIN))] * 2 + [(2, None, "", 0), (None, "v", "", 0), (3, "w", "é é", 3)]
    assert got == sorted(want, key=repr)
    assert extract_main_text(df.limit(0)).count() == 0


def test_wrappers_with_boilerplate_words_in_their_class():
    page = SITE.replace('<body class="home has-sidebar">', "<body>")
    for name in ("layout has-sidebar", "main-content with-sidebar", "comments-open", "page-with-nav", "promo-page", "hasSidebar", "ads-page no-sidebar"):
        for opening, closing in (("<article>", "</article>"), ("<main>", "</main>"), ('<div role="main">', "</div>"), ("<div>", "</div>")):
            assert main_text(page % (f'<div class="{name}">{opening}', f"{closing}</div>")) == MAIN, (name, opening)
            if name.startswith("main"):
                continue  # calls itself the content, so a header in it is the article's
            whole = page.replace("<body>", f'<body><div class="{name}">').replace("</body>", "</div></body>")
            assert main_text(whole % (opening, closing)) == MAIN, (name, opening)
        assert main_text(f'<body><main><div class="{name}"><article><p>The text of it is here.</p></article></div></main></body>') == "The text of it is here."


def test_articles_beside_the_own_one_stay_out():
    others = "<article><h2>Other story</h2><p>%s</p></article>" % ("The long text of another story is here. " * 20)
    for name in ("related-posts", "comments", "recommended", "teaser-list", "sidebar"):
        for own in ("<article><h1>Title</h1><p>The text of it is here, as it should be.</p></article>",
                    '<div class="layout has-sidebar"><article><h1>Title</h1><p>The text of it is here, as it should be.</p></article></div>',
                    '<div class="promo-page"><main><h1>Title</h1><p>The text of it is here, as it should be.</p></main></div>'):
            got = main_text(f'<body>{own}<div class="{name}">{others * 2}</div></body>')
            assert got == "Title\nThe text of it is here, as it should be.", (name, own)
    nav = '<form id="aspnet"><nav><p>Home and all the other sections of it.</p></nav><article><h1>Title</h1><p>The text of it.</p></article></form>'
    assert main_text(f"<body>{nav}</body>") == "Title\nThe text of it."


def test_words_that_are_topics_or_looks_do_not_decide():
    long = "A paragraph of the article with some words in it."
    for mark in ('class="more"', 'class="text-warning"', 'class="alert-level-info"', 'class="popular-science"', 'class="search-results-study"',
                 'id="legal-history"', 'id="toast-recipe"', 'class="cookie-recipe"', 'class="ad-hoc"', 'id="bottom"'):
        for outer in ("article", "main"):
            page = f"<body><nav><a href=1>Home</a></nav><{outer}><h1>Title</h1><p>{long}</p><p {mark}>{long}</p><p>{long}</p></{outer}><footer>x</footer></body>"
            assert main_text(page) == "\n".join(["Title", long, long, long]), (mark, outer)
    for mark in ('class="wp-sidebar"', 'class="share-buttons"', 'class="mailchimp-newsletter"', 'class="td-footer-wrap"', 'class="comment-list"',
                 'class="article__share"', 'class="post-comments"', 'id="comments"', 'class="cookie-notice"', 'class="ad"', 'class="adBox2"',
                 'class="related-posts"', 'class="advertisement-2"'):
        page = f"<body><article><h1>Title</h1><p>{long}</p><div {mark}><p>{long}</p></div><p>{long}</p></article></body>"
        assert main_text(page) == "\n".join(["Title", long, long]), mark


def test_list_of_links_in_an_article():
    links = "".join(f"<li><a href={i}>Source number {i}</a></li>" for i in range(5))
    page = f"<body><ul>{links}</ul><article><h1>Title</h1><p>The text of it is here.</p><ul>{links}</ul></article></body>"
    assert main_text(page) == "Title\nThe text of it is here.\n" + "\n".join(f"Source number {i}" for i in range(5))


def test_the_cut_overrules_single_blocks():
    """Neighbours change labels that a block's own score would give, both ways of a list."""
    text = "A paragraph of running text that goes on for a while, as they do."
    page = f"<body><div><p>{text}</p><p>{text}</p><p><a href=x>A whole line that is a link.</a></p><p>{text}</p></div></body>"
    blocks = text_blocks(page)
    own = [content_score(b, False) > 0 for b in blocks]
    assert own == [True, True, False, True] and main_blocks(blocks) == [True] * 4
    menu = "<ul>" + "<li><a href=x>Menu</a></li>" * 3 + "<li>Plain</li>" + "<li><a href=x>Menu</a></li>" * 3 + "</ul>"
    assert main_text(f"<body>{menu}<div><p>{text}</p><p>{text}</p></div></body>") == f"{text}\n{text}"
