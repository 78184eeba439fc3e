import pandas as pd
import pytest

from linkmill.functions.html import article, paragraph_text
from linkmill.operators import extract as E
from linkmill.operators.documents import successful


@pytest.mark.parametrize(
    "html, kept",
    [
        ("<p>one two three four</p>", ["one two three four"]),
        ("<p>one two three</p>", []),
        # Pieces between single spaces count before stripping, so outer spaces help.
        ("<p> one two three</p>", ["one two three"]),
        ("<p><b>one two three four</b></p>", ["one two three four"]),
        ("<p><a><b>one two three four</b></a></p>", ["one two three four"]),
        ("<p>one two <b>three</b> four</p>", []),
        ("<p>one two three four<br></p>", []),
        ("<p><b>open one two three<br><p>one two three four</p>", ["one two three four"]),
        ("<p>one two three four<p>five six seven eight", ["one two three four", "five six seven eight"]),
        ("<div><p>one two three four</div>tail", ["one two three four"]),
        ("<p>a &amp; b &lt; c</p>", ["a & b < c"]),
        ("<p>ﬁne café ½  x</p>", ["fine café 1⁄2  x"]),
        ("<script>var p = '<p>one two three four</p>'</script>", []),
    ],
)
def test_paragraphs(html, kept):
    text, words, count = paragraph_text(html)
    assert text == " ".join(kept) and count == len(kept)
    assert words == sum(len(k.split(" ")) for k in kept)


def test_article_prefers_article_then_the_fullest_container():
    page = (
        '<html lang="en-US"><head><title>A &amp;\n B</title><style>p{}</style></head><body><nav><p>menu</p></nav>'
        "<div><p>short</p></div>{}<footer><p>foot</p></footer></body></html>"
    )
    inside = page.replace("{}", "<article><h1>H</h1><p>first<br>line</p><p>second <b>bold</b></p></article>")
    assert article(inside) == ("A & B", "en", "first line\n\nsecond bold")
    without = page.replace("{}", "<div><p>much longer text</p><p>and more</p></div>")
    assert article(without)[2] == "much longer text\n\nand more"
    assert article("plain") == ("", "", "plain")


@pytest.mark.parametrize(
    "html, text",
    [
        ("<div>only a div<br>and more</div>", "only a div and more"),
        ("<article><p>a</p><pre>b\n c</pre><ul><li>d<li>e</ul><table><tr><td>f</table>g</article>", "a\n\nb c\n\nd\n\ne\n\nf\n\ng"),
        ("<article><form><p>open form, open paragraph</article><aside>no</aside>", "open form, open paragraph"),
        ("<div><nav>menu never closed<p>menu</div><div><p>the text</div>", "the text"),
        ("<h1>title</h1><h2>part</h2><p>text", "part\n\ntext"),
        ("<div><section>a</section><section>b</section></div>", "a\n\nb"),
        ("<div><section>" + "long words " * 30 + "</section><h2>x</h2><section>" + "words " * 20 + "</section>y</div>", ("long words " * 30).strip() + "\n\nx\n\n" + ("words " * 20).strip() + "\n\ny"),
        ("<div><div><div>" + "deep text " * 9 + "</div></div><div>few</div></div>", ("deep text " * 9).strip()),
        ("<table><tr><td>one cell<td>another cell</table>", "one cell\n\nanother cell"),
        ("<article>" + "<font><div>" * 20000 + "deep", "deep"),
    ],
)
def test_article_takes_all_blocks(html, text):
    assert article(html)[2] == text


def test_language_is_the_primary_subtag():
    assert [article(f'<html lang="{c}">')[1] for c in ("gsw-CH", "pt_BR", "EN", "x")] == ["gsw", "pt", "en", "x"]


def test_many_open_tags_take_linear_time():
    import time

    start = time.perf_counter()
    paragraph_text("<font><div>" * 40_000 + "<p>one two three four")
    assert time.perf_counter() - start < 5


def test_a_million_blanks_are_stripped_in_a_moment(spark):
    import time

    from pyspark.sql import functions as F

    from linkmill.functions.scalars import has_text, strip

    df = spark.createDataFrame([(" " * 500_000 + "x" + "\u2003" * 500_000,), (" " * 1_000_000,)], "t string").cache()
    df.count()
    start = time.perf_counter()
    got = df.select(strip(F.col("t")), has_text(F.col("t"))).collect()
    assert [tuple(r) for r in got] == [("x", True), ("", False)] and time.perf_counter() - start < 5


PAGES = [
    ("https://example.com/1", "<title>T</title><p>one two three four five</p>"),
    ("https://example.com/2", "<p> </p>"),
    ("https://example.com/3", None),
    ("https://imgur.com/4", "<p>one two three four five</p>"),
    ("https://example.com/5.pdf", "<p>one two three four five</p>"),
    ("not a url", "<p>one two three four five</p>"),
]


@pytest.fixture
def pages(spark):
    return spark.createDataFrame(PAGES, "url string, html string")


def test_every_page_has_an_outcome(spark, pages):
    found = E.extract_article(pages)
    rows = {r.url: r for r in found.collect()}
    assert {u: r.reason for u, r in rows.items()} == {
        "https://example.com/1": None,
        "https://example.com/2": "empty_text",
        "https://example.com/3": "error",
        "https://imgur.com/4": "blocked_domain",
        "https://example.com/5.pdf": "blocked_extension",
        "not a url": "invalid_url",
    }
    good = rows["https://example.com/1"]
    assert (good.text, good.meta.title, good.meta.word_count, good.meta.scraper) == ("one two three four five", "T", 5, "newspaper")
    assert good.meta.domain == "example.com" and good.meta.elapsed >= 0
    assert [r.url for r in successful(found).collect()] == ["https://example.com/1"]
    counts = {r.reason: (r.n, r.pct) for r in E.failures_by_reason(found).collect()}
    assert counts["ok"] == (1, 16.67) and len(counts) == 6


def test_excluded_pages_are_not_read(spark, pages):
    seen = spark.sparkContext.accumulator(0)

    def counting(batches):
        for batch in batches:
            seen.add(len(batch))
            yield pd.DataFrame(
                {"url": batch["url"], "text": "x", "title": None, "lang": None, "word_count": 1, "elapsed": 0.0,
                 "scraper": "own", "success": True, "error": None}
            )

    rows = E.extract(pages, counting).collect()
    assert seen.value == 3 and sum(r.success for r in rows) == 3
    plan = E.extract(pages, counting)._jdf.queryExecution().optimizedPlan().toString()
    assert "MapInPandas" in plan


def test_clean_html(spark):
    rows = [
        ("https://example.com/1", "<!DOCTYPE html><title>T</title>\n<script>a<b</script> <p>x  y</p><!-- c --><style>p{}</style>"),
        ("https://example.com/2", "<title>only a title</title><script>x</script><p> </p>"),
        ("https://imgur.com/3", "<p>x</p>"),
    ]
    got = E.clean_html(spark.createDataFrame(rows, "url string, html string")).collect()
    assert [(r.html, r.success) for r in got] == [("<title>T</title><p>x y</p>", True), (None, False), (None, False)]


def test_batch_errors(spark):
    df = spark.createDataFrame([(0, None), (0, "error"), (0, "empty_text"), (1, None)], "url_batch long, reason string")
    got = sorted(tuple(r) for r in E.failures_by_batch(df).collect())
    assert got == [(0, 3, 2, 66.67), (1, 1, 0, 0.0)]


def test_clean_markup_drops_inline_scripts_and_keeps_pre(spark):
    from pyspark.sql import functions as F

    from linkmill.functions.html import clean_markup

    cases = {
        """<a href="javascript:x()" onclick="a > b" class='c' ONLOAD='y'>t</a>""": "<a class='c'>t</a>",
        "<p>so on = \"x\" it  goes</p>": "<p>so on = \"x\" it goes</p>",
        "<div> <pre>a\n  b</pre> <p>c\n d</p></div>": "<div><pre>a\n  b</pre><p>c d</p></div>",
        "<pre>open\n  end": "<pre>open\n  end",
        "<script>x</script> <!-- y -->": None,
    }
    df = spark.createDataFrame([(k,) for k in cases], "html string")
    assert {r.html: r.c for r in df.select("html", clean_markup(F.col("html")).alias("c")).collect()} == cases


def test_extractors_get_bounded_parts(spark):
    def sizes(parts):
        for part in parts:
            row = {"success": True, "text": "x", "word_count": sum(len(h or "") for h in part["html"]), "elapsed": float(len(part))}
            yield pd.DataFrame([{"url": u, **row} for u in part["url"]], columns=[c.split()[0] for c in E.EXTRACTED.split(", ")], dtype=object)

    # In one task: small pages, large ones, one larger than a part, and none at all.
    lengths = [10] * 1200 + [300_000] * 12 + [3 << 20] + [0] * 3
    rows = [(f"https://a.example.org/{i}", "y" * n if n else None) for i, n in enumerate(lengths)]
    pages = spark.createDataFrame(rows, "url string, html string").coalesce(1)
    got = E.extract(pages, sizes).select("url", "meta.word_count", "meta.elapsed").collect()
    assert sorted(r.url for r in got) == sorted(url for url, _ in rows)
    assert max(r.elapsed for r in got) <= E.PART_ROWS
    assert {r.word_count for r in got if r.word_count > E.PART_CHARS} == {3 << 20}
