import html as entities
import re
import time

import pytest

from linkmill.llm.main_text import extract_pages, main_text, op4_main_text

PAGES = {
    "": "",
    "   ": "",
    "plain words": "plain words",
    "<p>a<p>b": "a b",
    "<body>one<br>two<ul><li>a b<li>c &amp; d</ul><pre> x  y </pre>": "one two a b c & d x y",
    "<script>var t='<p>no</p>'</script><!-- <p>no</p> --><style>p{}</style><p>yes</p>": "yes",
    "<header>site</header><nav><a href=/>Home</a></nav><article><header><h1>T</h1></header><section><p>One, two.</p></section>"
    "<section><p>Four</p><div class='comments'><p>no</p></div><form><p>no</p></form></section></article>"
    "<aside>no</aside><div class=ad>no, no, no, no.</div><footer>no</footer>": "T One, two. Four",
    "<div id='cookie-notice'>We, use, cookies, and, more, commas, than, text.</div><main><p>Short.</p></main>": "Short.",
    "<article><p><b>A&nbsp;b &eacute; &#x41;<br><p>c</p></article>": "A b é A c",
    "<article><table><tr><td>a<td>b<tr><td>c</table><ul><li><a href=1>menu</a><li><a href=2>menu</a></ul></article>": "a b c",
    "<div><p>First part, with commas, and a good length of text so that it counts as prose here.</p></div>"
    "<div><p>Second part, with commas, and a good length of text so that it counts as prose, too.</p></div>": "First part, with"
    " commas, and a good length of text so that it counts as prose here. Second part, with commas, and a good length of"
    " text so that it counts as prose, too.",
    "<p title='a > b'>x</p><p title='never closed>y</p>": "x y",
}


@pytest.mark.parametrize("page", list(PAGES))
def test_small_pages(page):
    assert main_text(page) == PAGES[page]


@pytest.mark.parametrize("page", ["<div><div>" * 30000 + "hi", '<a "' * 60000, "<b><i>" * 30000 + "</b>" * 30000, "<li>" * 40000, "<!--" * 50000, "<p>" + "x, " * 500000])
def test_broken_and_very_long_pages_take_linear_time(page):
    start = time.time()
    main_text(page)
    assert time.time() - start < 20


def test_whole_table_equals_the_article_of_each_page(spark, sf):
    pages = {r.page_id: r for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    rows = op4_main_text(spark, sf).collect()
    assert len(rows) == len(pages)
    for row in rows:
        article = re.search(r"(?s)<article>(.*?)</article>", pages[row.page_id].html)[1]
        parts = [" ".join(entities.unescape(re.sub("<[^>]*>", " ", b)).split()) for b in re.split(r"</?p>|</?h1>", article)]
        assert row.text == " ".join(p for p in parts if p)
        assert row.n_chars == len(row.text) and row.url == pages[row.page_id].url


def test_nulls_repeated_rows_clashing_columns_and_empty_tables(spark):
    rows = [(1, None, "a"), (1, None, "a"), (None, "<p>x", None)]
    pages = spark.createDataFrame(rows, "page_id long, html string, text string")
    got = extract_pages(pages).collect()
    assert sorted((r.page_id or 0, r.text, r.n_chars) for r in got) == [(0, "x", 1), (1, "", 0), (1, "", 0)]
    assert extract_pages(pages).columns == ["page_id", "text", "n_chars"] and extract_pages(pages.limit(0)).count() == 0


_LONG = " ".join(f"<p>Paragraph {n} of the text, with a comma, and enough words to count as prose in any score.</p>" for n in range(6))
_TEXT = re.sub("<[^>]*>", "", _LONG)


@pytest.mark.parametrize(
    "before, after",
    [
        ("<div class='layout has-sidebar'><article>", "</article><div class=sidebar><p>no</p></div></div>"),
        ("<div class='content no-sidebar'>", "</div>"),
        ("<div id='page' class='with-comments'>", "<div id=comments><p>no</p></div></div>"),
        ("<form id=aspnet><nav><a href=1>no</a></nav><div>", "</div><div class='cookie-notice'>no</div></form>"),
        ("<form action=search><input name=q><article>", "</article>"),
        ("<div class='sidebar'><article>", "</article></div><div>Short words.</div>"),
        ("<main><p>Intro.</p><form>", "</form></main>"),
        ("<div class='right-sidebar'><div>", "</div><div class='site-footer'>no</div></div>"),
    ],
)
def test_marked_wrappers_of_the_text_lose_nothing(before, after):
    got = main_text(before + _LONG + after)
    assert _TEXT in got and "no" not in got.replace(_TEXT, "").split()


@pytest.mark.parametrize("wrapper", ["elementor-widget-container", "widget", "widget widget-text"])
def test_a_page_builder_that_wraps_each_paragraph(wrapper):
    page = "<div>" + re.sub("<p>.*?</p>", lambda p: f"<div class='{wrapper}'>{p[0]}</div>", _LONG) + "</div><nav><a href=1>no</a></nav>"
    assert main_text(page) == _TEXT
    assert main_text(f"<main><p>Intro.</p>{page}</main>") == "Intro. " + _TEXT


def test_marked_text_beside_an_article_is_still_dropped():
    for mark in ("class=comments", "id=cookie-notice", "class='site-footer'", "class=sidebar"):
        assert main_text(f"<article><p>Short.</p></article><div {mark}>{_LONG}</div>") == "Short."
    assert main_text(f"<article><p>Short.</p><div id=comments>{_LONG}</div></article>") == "Short."
    assert main_text(f"<div>{_LONG}</div><aside><article><p>Teaser.</p></article></aside>") == _TEXT
    assert main_text("<p>One<span class=ad>no</span> two") == "One two"


def test_uneven_sections_without_an_article_all_stay():
    sentence = "These are words, three of them, with commas, and so on and on " + "to fill a paragraph " * 11
    best = "<section>" + f"<p>{sentence}</p>" * 5 + "</section>"
    rest = f"<h2>Second part</h2><section><p>{sentence[:150].replace(',', '', 2)}</p></section><p>Short.</p><h3>Facts</h3>"
    rest += "<ul><li>one</li><li>two</li></ul><table><tr><td>a</td><td>b</td></tr></table>right in the parent"
    want = " ".join(re.sub("<[^>]*>", " ", best + rest).split())
    menu = "<ul><li><a href=1>no</a></li></ul><div><a href=1>no</a> | <a href=2>no</a></div><div class=comments>no</div>"
    assert main_text(f"<div>{menu}{best}{rest}{menu}</div>") == want
    assert main_text(f"<div><div><div>{best}</div></div></div>{menu}<div><div>{rest}</div></div>") == want


@pytest.mark.parametrize(
    "name",
    "post-comments comments-wrapper reader-comments article-comments user-comment ad-container ad-wrapper cookie-notice-container"
    " cookie-law-info newsletter-form share-buttons-wrapper related-posts sidebar-content site-header page-header header commentList"
    " adBox sidebar site-footer AD_SLOT commentsArea".split(),
)
def test_marked_noise_is_dropped_wherever_it_stands(name):
    noise = f"<div class='x {name}'><p>no, no and no: a paragraph of noise, with commas, as long as others are.</p></div>"
    assert main_text(f"<article>{_LONG}{noise}</article>") == _TEXT
    assert main_text(f"<div>{_LONG}{noise}</div>") == _TEXT
    assert main_text(f"<div>{noise}{_LONG}</div>") == _TEXT
    assert main_text(f"<article>{_LONG}</article>{noise}") == _TEXT
    assert main_text(f"<div><div>{_LONG}</div>{noise.replace('class', 'id')}</div>") == _TEXT


@pytest.mark.parametrize("name", ["has-comments", "no-ads", "with-related-posts", "isAdFree", "ad-free", "without_sidebar", "header-free", "footnotes", "loading", "shadow", "commentary"])
def test_words_that_deny_or_only_resemble_mark_nothing(name):
    assert main_text(f"<article>{_LONG}<div class='{name}'><p>yes</p></div></article>") == _TEXT + " yes"


def test_comments_of_listings_and_the_articles_own_header_stay():
    code = "<pre><code>x = 1 <span class='hljs-comment'># one</span></code></pre>"
    assert main_text(f"<article>{_LONG}{code}</article>") == _TEXT + " x = 1 # one"
    assert main_text(f"<article><div class='entry-header'><h1>Title</h1><p>By A</p></div>{_LONG}</article>") == "Title By A " + _TEXT
