"""Main text of pages written for the purpose, and of the given ones."""

import html
import re

from pyspark.sql import functions as F

import math
import random
import time

import pytest

from ballotlake.llm import common
from ballotlake.llm.html_text import _Page, extract, main_text, query


def test_article_between_menus_and_adverts():
    page = """<!DOCTYPE html><html><head><title>No</title><style>p{}</style></head><body>
    <header><h1>Site</h1></header><nav><ul><li><a href=/>Home</a></li></ul></nav>
    <div class="cookie-notice">We use cookies and this sentence is long enough to be taken for an article.</div>
    <div id=main><h1>The  title</h1><p>First &amp; <b>bold</b>&nbsp;text.<p>Second
    line<br>goes on.<ul><li>one<li>two</ul><script>var x = "<p>no</p>";</script><!-- no --></div>
    <div class='sidebar'>Other stories that nobody asked for are listed here at some length.</div>
    <form><label>Name</label><input value=x></form>
    <section id="comments"><p>I do not agree with any of this at all.</p></section>
    <footer>&copy; 2024</footer></body></html>"""
    assert main_text(page) == "The title\nFirst & bold text.\nSecond line goes on.\none\ntwo"


def test_link_lists_lose_against_text():
    links = "".join(f'<li><a href="/{k}">Link number {k} to somewhere</a></li>' for k in range(40))
    body = "".join(f"<p>Paragraph {k} has words of its own, which is what an article is made of.</p>" for k in range(4))
    text = main_text(f"<body><div><ul>{links}</ul></div><div>{body}</div></body>")
    assert text.count("\n") == 3 and "Link number" not in text


def test_article_header_and_short_paragraphs_stay():
    page = "<body><article><header><h1>Title</h1></header><div><p>A.</p></div><p>B.</p><aside>no</aside></article><p>beside</p></body>"
    assert main_text(page) == "Title\nA.\nB."


def test_density_decides_beside_small_articles():
    text = "".join(f"<p>Paragraph {k} tells at some length what this page is about, and goes on.</p>" for k in range(12))
    plain = re.sub("<[^>]*>", "\n", text).split("\n")
    cards = "".join(f"<article><h2>Card {k}</h2><p>Another story to be read elsewhere on this site, and it goes on there.</p></article>" for k in range(4))
    for page in (f"<div>{cards}</div><div>{text}</div>", f"<div>{cards}</div>{text}", f"<div>{text}</div>{cards}"):
        assert set(filter(None, plain)) <= set(main_text(f"<body>{page}</body>").split("\n"))
    # Text beside an article stays where it reaches the threshold.
    further = "<p>" + "Further words are told in one long paragraph. " * 12 + "</p>"
    both = main_text(f"<body><article><h1>Title</h1>{text}</article>{further}</body>")
    assert both.startswith("Title\n") and both.count("Paragraph") == 12 and both.count("Further") == 12
    assert main_text(f"<body><ul><li><a href=/>Home page</a></li></ul><div>{text}</div></body>").split("\n") == list(filter(None, plain))


def test_named_wrappers_of_the_page_stay():
    text = "".join(f"<p>Paragraph {k} tells at some length what this page is about, and goes on.</p>" for k in range(12))
    lines = [line for line in re.sub("<[^>]*>", "\n", text).split("\n") if line]
    notice = '<div class="cookie">We use cookies.</div><div class="sidebar"><p>Other stories.</p></div>'
    for opened, closed in (
        ('<div class="layout has-sidebar">', "</div>"), ('<div id="page" class="no-ads">', "</div>"),
        ('<div class="share-enabled">', "</div>"), ('<div role="dialog">', "</div>"), ("<form action=/>", "</form>"),
        ("<form><fieldset>", "</fieldset></form>"), ("<label>", "</label>"), ("<nav>", ""),
    ):
        page = f"<body>{opened}{notice}<article>{text}</article>{closed}</body>"
        assert main_text(page).split("\n") == lines, opened
        page = f"<body>{opened}{notice}<main class='has-sidebar'>{text}</main>{closed}</body>"
        assert main_text(page).split("\n") == lines, opened
        page = f"<body>{opened}{notice}<div>{text}</div>{closed}</body>"
        if "nav" not in opened and "label" not in opened:
            assert main_text(page).split("\n") == lines, opened
    comments = '<section id="comments"><article class="comment"><p>I do not agree.</p></article></section>'
    assert main_text(f"<body><article>{text}</article>{comments}</body>").split("\n") == lines
    form = "<form><p>Paragraph.</p><select><option>one</option></select><button>Send</button><textarea>no</textarea></form>"
    assert main_text(f"<body>{form}</body>") == "Paragraph."


ARTICLE = "<p>The first paragraph tells what has happened, and where.</p><p>The second one goes on about it at length.</p>"
LINES = ["The first paragraph tells what has happened, and where.", "The second one goes on about it at length."]


@pytest.mark.parametrize("times", [0.5, 1, 3, 10, 100])
@pytest.mark.parametrize("body", [f"<article>{ARTICLE}</article>", f'<div class="post">{ARTICLE}</div>', f"<main>{ARTICLE}</main>",
                                  f'<div class="layout has-sidebar"><div>{ARTICLE}</div></div>'])
def test_boilerplate_of_any_size_is_left_out(times, body):
    count = max(1, round(2 * times))
    words = "Nobody asked for these words, and they stand here at some length."
    comments = f"<section id=comments>{f'<article class=comment><p>{words}</p></article>' * count}</section>"
    parts = [
        comments, comments.replace(" class=comment", ""), comments.replace("<article class=comment>", "<div>").replace("</article>", "</div>"),
        f'<div class="cookie-notice"><p>{words * count}</p></div>', f'<div class="cookie-notice">{f"<p>{words}</p>" * count}</div>',
        f"<div class=sidebar>{f'<p>{words}</p>' * count}</div>", f"<aside>{f'<article><p>{words}</p></article>' * count}</aside>",
        f"<footer>{f'<p>{words}</p>' * count}</footer>", f"<div role=complementary>{f'<p>{words}</p>' * count}</div>",
    ]
    for part in parts:
        for page in (body + part, part + body, f"<div id=page>{part}{body}</div>", f"<div class='no-ads'><a href=/>Home</a>{body}{part}</div>"):
            assert main_text(f"<body>{page}</body>").split("\n") == LINES, (part[:60], page[:60])


def test_last_words_beside_an_article_stay():
    short = "<article><p>He came.</p><p>He saw.</p></article>"
    assert main_text(f"<body>{short}<p>Finished.</p></body>").split("\n") == ["He came.", "He saw.", "Finished."]
    assert main_text(f"<body>{short}<p>Share</p></body>").split("\n") == ["He came.", "He saw."]


def test_tags_of_any_number_take_linear_time():
    many = 100_000
    pages = ["<b>" * many + "</i>" * many + "x", "<b>" * many + "<hr>" * many + "x", "<b>" * many + "<li>" * many + "x",
             "<ul>" * 1000 + "<b>" * many + "</li>" * many + "x", "<i><b>" * (many // 2) + "</i>" * many + "x", "<td>x" * many,
             "<div class=ad>" * many + "x", "<article>" * many + "x", "<p>" * many + "</div>" * many + "x"]
    started = time.process_time()
    for page in pages:
        assert "x" in main_text(page)
    assert time.process_time() - started < 4 * len(pages)
    started = time.process_time()
    main_text(pages[0])
    assert time.process_time() - started < 2


def plain_density(page, node):
    """The composite text density of a node, from its subtree alone."""
    children = [n for n in range(len(page.parent)) if page.parent[n] == node and not page.out[n]]

    def counts(n, linked):
        linked |= page.name[n] == "a"
        chars = sum(len("".join(text.split())) for at, _, text in page.texts if at == n)
        total = [chars, chars if linked else 0, 0, 0]
        for child in range(len(page.parent)):
            if page.parent[child] == n and not page.out[child]:
                part = counts(child, linked)
                total = [total[0] + part[0], total[1] + part[1], total[2] + part[2] + 1, total[3] + part[3] + (page.name[child] == "a")]
        return total

    def linked(n):
        return n >= 0 and (page.name[n] == "a" or linked(page.parent[n]))

    c, lc, t, lt = counts(node, linked(page.parent[node]))
    whole = counts(0, False)
    if not c:
        return 0.0, children
    t, lt = max(t, 1), max(lt, 1)
    base = math.log(c / max(c - lc, 1) * lc + whole[1] / max(whole[0], 1) * c + math.e)
    inside = c / max(lc, 1) * t / lt
    return c / t * (math.log(inside + 1e-9) / math.log(base + 1e-9) if base > 1 else math.log(inside + math.e)), children


def test_densities_and_sums_of_random_trees():
    dice = random.Random(8)
    for _ in range(60):
        source = "".join(dice.choice(["<div>", "</div>", "<p>", "<a href=x>", "</a>", "<b>", "</b>", "word ", "more words here ", "<nav>z</nav>", "<li>"])
                         for _ in range(40))
        page = _Page(source)
        density, total = page.densities()
        for node in range(len(page.parent)):
            if page.out[node]:
                continue
            want, children = plain_density(page, node)
            assert density[node] == pytest.approx(want)
            assert total[node] == pytest.approx(sum(plain_density(page, child)[0] for child in children))


def test_defined_results():
    assert main_text(None) == main_text("") == main_text("<nav>x</nav>") == ""
    assert main_text("just  text") == "just text"
    assert main_text("<p>a < b and 3 > 2 &lt;tag&gt; &#233;&unknown;</p>") == "a < b and 3 > 2 <tag> é&unknown;"
    assert main_text("<div" * 50_000).startswith("<div<div")
    assert main_text('<p title="a > b">x</p><p title=">y</p>') == "x\ny"
    assert len(main_text("<div>" * 20_000 + "deep" + "</div>" * 20_000)) == 4
    assert main_text("<article>" + "<p>w</p>" * 30_000 + "</article>").count("\n") == 29_999
    assert main_text("<body><p>x<!-- open") == "x"
    assert main_text("<body><p>x</p><script>never closed") == "x"


def test_given_pages(spark, sf):
    pages = {r.page_id: r for r in common.table(spark, sf, "pages").collect()}
    rows = query(spark, sf).collect()
    assert len(rows) == len(pages)
    for r in rows:
        source = pages[r.page_id].html
        article = re.split("</article>|<footer", source.split("<article>", 1)[1])[0]
        blocks = [" ".join(html.unescape(re.sub("<[^>]*>", "", b)).split()) for b in re.split("</?p>|</?h1>", article)]
        assert r.text == "\n".join(b for b in blocks if b)
        assert (r.n_chars, r.url) == (len(r.text), pages[r.page_id].url)


def test_edge_cases(spark):
    rows = [(1, None, None), (None, "u", "<p>a</p>"), (2, "u", "<p>a</p>"), (2, "u", "<p>a</p>"), (3, "", "")]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string").withColumns({"text": F.lit(1), "n_chars": F.lit(2)})
    found = sorted(((r.page_id or 0, r.url, r.text, r.n_chars) for r in extract(frame).collect()), key=str)
    assert found == sorted([(1, None, "", 0), (0, "u", "a", 1), (2, "u", "a", 1), (2, "u", "a", 1), (3, "", "", 0)], key=str)
    assert extract(frame.limit(0)).count() == 0
