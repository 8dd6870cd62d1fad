import pytest

from tabproof.llm.html_extract import Page, extract_pages

SCHEMA = "page_id bigint, url string, html string"
FRAME = """<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var t="</p>";</script></head>
<body class="with-sidebar"><header><h1>Site</h1></header><nav><ul><li><a href=/>Home</a></ul></nav>
<div class="cookie-notice">We use cookies here and there and everywhere.</div><div class="wrap-{n}">
<div id="sidebar"><p>Other things that you may like to read</p></div><div class="post post-{n}">{body}
<form><p>Sign up</p><input></form><section class="comments"><article class="comment">Nice one</article></section>
</div></div><div class="ad">Buy this now, it is good</div><footer>&copy; me</footer>{end}"""


def page(n, body, end="</body></html>"):
    return FRAME.format(n=n, body=body, end=end)


def test_article_of_a_framed_page():
    body = "<h2>Tit&eacute;l</h2><p>One <a href=x>link</a>\n and &lt;more&gt;&nbsp;<b>here<br><p>Two<ul><li>a<li>b</ul>"
    text = Page(page(3, body)).text(None)
    assert text == "Titél\nOne link and <more> here\nTwo\na\nb"


def test_the_host_decides_where_a_page_errs(spark):
    """On the short page the unmarked notice is longer than the article."""
    frame = '<body><div class="c{}"><p>{}</p></div><div class="x">{}</div></body>'
    rows = [(i, f"http://h.com/{i}", frame.format(i, "long text of an article " * 9, "note")) for i in range(5)]
    rows += [(9, "http://h.com/9", frame.format(9, "short", "a notice that is rather long"))]
    rows += [(10, "http://other.com/9", frame.format(9, "short", "a notice that is rather long"))]
    found = {r["page_id"]: r["text"] for r in extract_pages(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert found[9] == "short" and "notice" in found[10]


@pytest.mark.parametrize("html", [
    "", " ", "<", "<p", "plain", "<p>a<p>b", "</p></div>x", "<!-- <p>no</p>", "<script>never ends <p>x",
    "<a title='x>y", "<div>" * 3000 + "deep" + "</div>" * 3000, "<table><tr><td>1<td>2<tr><td>3</table>",
    "&amp;&#x41;&bogus;", "<p hidden>x</p>y",
])
def test_broken_html_is_read(html):
    text = Page(html).text(None)
    assert "<p>" not in text
    expected = {"plain": "plain", "<p>a<p>b": "a\nb", "</p></div>x": "x", "<p hidden>x</p>y": "y",
                "<table><tr><td>1<td>2<tr><td>3</table>": "1\n2\n3", "&amp;&#x41;&bogus;": "&A&bogus;"}
    if html in expected:
        assert text == expected[html]
    if "deep" in html:
        assert text == "deep"


def test_table(spark):
    rows = [(1, "http://a.com/1", page(1, "<p>Some text of one</p>")), (1, "http://a.com/1", page(1, "<p>Some text of one</p>")),
            (2, None, page(2, "<p>No address</p>", end="")), (3, "http://b.com/", None), (4, "", ""), (None, None, None)]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'x' AS host", "'y' AS path", "1 AS text", "2 AS n_chars")
    found = extract_pages(df)
    assert found.columns == ["page_id", "url", "text", "n_chars", "path"]
    result = sorted(((r["page_id"], r["text"], r["n_chars"]) for r in found.collect()), key=repr)
    assert result == sorted([(1, "Some text of one", 16)] * 2 + [(2, "No address", 10), (3, "", 0), (4, "", 0),
                                                               (None, "", 0)], key=repr)
    assert extract_pages(spark.createDataFrame([], SCHEMA)).count() == 0


def test_given_pages(spark):
    """The synthetic pages hold one article element each."""
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    html = {r["page_id"]: r["html"] for r in pages.collect()}
    for row in extract_pages(pages).collect():
        inner = html[row["page_id"]].split("<article>")[1].split("</article>")[0]
        assert row["text"] == Page(f"<main>{inner}</main>").text(None)
        assert row["n_chars"] == len(row["text"]) > 0


@pytest.mark.parametrize("html, expected", [
    ("<div class='overflow-hidden'><p>All of it</p></div>", "All of it"),
    ("<div class='social-layout'><h1>Title</h1><article><p>All of it</p></article>"
     "<section class=comments><article>Nice one</article></section></div><p>Below", "Title\nAll of it\nBelow"),
    ("<article class='post sponsored'><p>All of it</p></article><div>Lo</div>", "All of it"),
    ("<div class='promo'><p>All of it</p></div>", "All of it"),
    ("<html><head><title>T</title><meta charset=utf-8><body><p>All of it</p></html>", "All of it"),
    ("<head><link rel=x href=y><p>All of it", "All of it"),
    ("<head><title>T</title>All of it", "All of it"),
    ("<div class='hidden'>Not this</div><p>All of it", "All of it"),
    ("<div class='social' hidden><article>Not this</article></div><p>All of it", "All of it"),
    ("<p>All of it<section class='related'><article class='related'>Not this</article></section>", "All of it"),
])
def test_words_and_open_heads_lose_no_article(html, expected):
    assert Page(html).text(None) == expected


def test_an_article_in_parts_comes_whole(spark):
    """Parts of one generalised path around an advert, title and lead beside them."""
    html = ("<body><div class=page><div class=top><h1>Title {0}</h1></div><p>A lead outside</p>"
            "<div class='post-1'><p>{1}</p></div><div class=ad>Buy this</div><div class='post-2'><p>{2}</p></div>"
            "<div class='post-3'><a href=x>See also</a></div><div class=x>A note</div></div></body>")
    rows = [(i, f"http://h.com/{i}", html.format(i, "first part " * 30, "second part " * (5 + i))) for i in range(4)]
    for row in extract_pages(spark.createDataFrame(rows, SCHEMA)).collect():
        i = row["page_id"]
        assert row["text"].split("\n") == [
            f"Title {i}", "A lead outside", ("first part " * 30).strip(), ("second part " * (5 + i)).strip(), "See also"]


def test_a_hint_does_not_outweigh_half_the_text():
    html = f"<div class=intro>{'lead ' * 40}</div><article>{'text ' * 60}</article>"
    assert Page(html).text(None).split() == ["lead"] * 40 + ["text"] * 60
    assert Page("<div><p><a href=x>All linked</a></p></div>").text(None) == "All linked"
