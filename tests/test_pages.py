from pyspark.sql import functions as F

from tests.conftest import rows_of
from wordloom.operators import pages as P

FORUM = """<html><head><title> A &amp; B </title></head><body>
<p class="xg1 date">2024-1-2 | <a href="/u">Pen<b>ulis</b></a></p>
<em id="_viewnum">1,234</em><em id="_commentnum">2</em>
<table><tr><td id="article_content"> Hari <table><tr><td>ini</td></tr></table><script>x()</script> hujan<!-- c --> lagi </td>
<td>luar</td></tr></table>
<div id="comment_ul">
<dl id="comment_12_li"><a class="xi2"> user </a><dd><div class="quote">q<div>r</div></div> text <i>more</i></dd></dl>
<dl id="comment_x"><dt>no body</dt></dl>
<dl><dd>no id</dd></dl>
</div>
<dl id="comment_9"><dd>outside</dd></dl></body></html>"""


def pages(spark, *htmls):
    return spark.createDataFrame(list(enumerate(htmls)), "page_id bigint, html string")


def test_forum_page(spark):
    records = P.extract_pages(pages(spark, FORUM))
    assert [tuple(r) for r in P.articles(records).collect()] == [
        (0, "A & B", "2024-1-2", "Penulis", 1234, 2, "Hariinihujanlagi")]
    assert [tuple(r) for r in P.comments(records).collect()] == [
        (0, 12, "user", "textmore"), (0, 0, "Anonymous", "No comment text")]


def test_joiner(spark):
    records = P.extract_pages(pages(spark, FORUM), spec=P.PageSpec(joiner=" "))
    assert P.articles(records).first().Content == "Hari ini hujan lagi"


def test_absent_tags_get_defaults_and_empty_tags_do_not(spark):
    records = P.extract_pages(pages(spark, "<p>x</p>", "<title></title>", "<em id='_viewnum'>n/a</em>"))
    assert rows_of(P.articles(records)) == [
        (0, "Unknown", "Unknown", "Unknown", 0, 0, ""),
        (1, "", "Unknown", "Unknown", 0, 0, ""),
        (2, "Unknown", "Unknown", "Unknown", 0, 0, ""),
    ]
    assert P.comments(records).count() == 0


def test_unreadable_pages_keep_their_ids(spark):
    def extractor(page_id, html):
        if page_id == 1:
            raise ValueError("broken")
        if page_id == 3:
            return {"Article": {"AID": "no number"}}
        return P.page_record(page_id, html)

    records = P.extract_pages(pages(spark, FORUM, FORUM, None, FORUM), extractor)
    articles = P.articles(records).collect()
    assert len(articles) == 4 and sum(row.AID is None for row in articles) == 3
    assert P.comments(records).count() == 2
    rejects = rows_of(P.page_rejects(records))
    assert [i for i, _ in rejects] == [1, 2, 3] and rejects[:2] == [(1, "ValueError: broken"), (2, "no html")]


def test_large_page_ids(spark):
    df = spark.createDataFrame([(3_000_000_000, FORUM)], "page_id bigint, html string")
    records = P.extract_pages(df)
    assert P.articles(records).first().AID == P.comments(records).first().AID == 3_000_000_000


def test_deep_pages_are_read(spark):
    html = "<td id='article_content'>" + "<p>" * 10_000 + "deep" + "</b>" * 10_000 + "</td>"
    records = P.extract_pages(pages(spark, html))
    assert P.articles(records).first().Content == "deep" and P.page_rejects(records).count() == 0
    assert P.page_text(pages(spark, html)).first().text == "deep"


def test_character_references(spark):
    html = "<title>caf&eacute; &amp;lt;</title><td id='article_content'>it&rsquo;s &#8364;5 &#x20AC;6 &notin;</td>"
    record = P.articles(P.extract_pages(pages(spark, html))).first()
    assert (record.Title, record.Content) == ("café &lt;", "it’s €5 €6 ∉")
    assert P.page_titles(pages(spark, html)).first().title == record.Title
    assert P.page_text(pages(spark, html)).first().text == "café &lt; it’s €5 €6 ∉"


def test_links_in_every_quoting(spark):
    html = """<a href='/one'>1</a><a class=x href=/two>2</a><A HREF="/three?a=1&amp;b=2" title="x > y">3 <b>&lt;</b></A><a name=q>4</a>"""
    assert rows_of(P.page_links(pages(spark, html))) == [(0, 0, "/one", "1"), (0, 1, "/two", "2"), (0, 2, "/three?a=1&b=2", "3 <")]


def test_unclosed_and_stray_tags(spark):
    html = "<td id='article_content'><p><b>a<br><p>b</i></p>c &lt; d</td>e"
    assert P.articles(P.extract_pages(pages(spark, html))).first().Content == "abc < d"


def test_flat_page(spark):
    row = P.read_pages(pages(spark, FORUM)).first()
    assert row.title == "A & B" and row.problem is None
    assert "x()" not in row.text and " c " not in row.text and row.text.startswith("A & B 2024-1-2 | Pen ulis 1,234")
    assert [tuple(link) for link in row.links] == [("/u", "Penulis")]
    assert P.page_text(pages(spark, FORUM), joiner="").first().text.startswith("A & B 2024-1-2 | Penulis 1,2342")


def test_title_default(spark):
    assert rows_of(P.page_titles(pages(spark, "<p>", "<title>t</title>"))) == [(0, "Unknown"), (1, "t")]
    assert P.page_titles(pages(spark, "x")).select(F.col("title")).first()[0] == "Unknown"


def test_a_record_that_does_not_fit_leaves_its_neighbours_alone(spark):
    def extractor(page_id, html):
        article = {"Title": "t" + html, "Publisher": "p", "Views": "many" if page_id == 2 else 3, "Comments_Count": 0, "Content": "c"}
        return {"Article": article, "Comments": [], **({"page_id": "?"} if page_id == 4 else {})}

    stored = spark.createDataFrame([(i, str(i)) for i in range(1, 6)], "page_id bigint, html string").coalesce(1)
    rows = {r.page_id: r for r in P.extract_pages(stored, extractor).collect()}
    assert sorted(rows) == [1, 2, 3, 4, 5]
    assert all(rows[i].Article.Title == f"t{i}" and rows[i].problem is None for i in (1, 3, 5))
    assert all(rows[i].Article is None and rows[i].problem for i in (2, 4))
