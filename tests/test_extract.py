import datetime

import pytest
from pyspark.sql import functions as F

from newsloom.operators import extract, reports
from newsloom.plans.ingest import read_articles, with_reading_rules
from newsloom.sources.config import Site, sites_table

SITE = Site(
    website="acme",
    start_point="http://acme.tld/",
    selectors={
        "title": "#a h1", "description": "#a .d", "content": "#a .c",
        "author": "#a .by", "date": "#a time", "thumbnail": "#a .t",
    },
    date_format="{DAY_NUM} {MONTH_LONG} {YEAR_LONG}",
)
GOOD = "<h1> T\t</h1><time>\n2 May 2006 </time>"


def page(inner, content="x"):
    return f'<html><body><div id=a>{inner}<div class=c>{content}</div></div></body></html>'


def read(spark, htmls, url="http://acme.tld/news/1?p=1", **options):
    rows = [(i, "acme", url, h) for i, h in enumerate(htmls)]
    pages = spark.createDataFrame(rows, "page_id bigint, website string, url string, html string")
    ruled = with_reading_rules(pages, sites_table(spark, [SITE]))
    done = read_articles(ruled, keep_links=True, **options)
    return [r.asDict() for r in done.orderBy("page_id").collect()]


def test_complete_article(spark):
    inner = (
        GOOD + "<p class=d> about </p><span class=by> \nAnn</span>"
        '<p>x</p><img class=t src="/i.png">'
    )
    (got,) = read(spark, [page(inner, 'é &amp; "q" <b>b</b>')])
    assert got["reason"] is None and got["warnings"] == []
    assert (got["title"], got["description"], got["author"]) == ("T", "about", "Ann")
    assert got["date"] == datetime.date(2006, 5, 2)
    assert got["content"] == '<img class="t" src="http://acme.tld/i.png"/>é &amp; &#34;q&#34; <b>b</b>'


def test_article_predicate_and_counts(spark):
    pages = [
        page("<h1>T</h1>"),
        page(GOOD + "<h1>again</h1>"),
        page(GOOD) + page(GOOD),
        page(GOOD + "<time>3 May 2007</time>"),
        "",
    ]
    got = read(spark, pages)
    assert [r["reason"] for r in got] == ["not_article"] * 3 + [None, "not_article"]
    assert got[0]["detail"] == "content_matches=1 title_matches=1 date_matches=0"
    assert got[2]["detail"] == "content_matches=2 title_matches=2 date_matches=2"
    assert got[3]["date"] == datetime.date(2006, 5, 2)


@pytest.mark.parametrize(
    "mode, titles",
    [("first_text", ["in b", "T", None, "T", " c "]), ("first_child", ["b", "T", None, "a", " c "])],
)
def test_title_text(spark, mode, titles):
    time = "<time>2 May 2006</time>"
    pages = [
        page("<h1><b>in b</b> out</h1>" + time),
        page("<h1>T<b>u</b></h1>" + time),
        page("<h1></h1>" + time),
        page("<h1><a>T</a></h1>" + time),
        page("<h1>&#13;\t\n c &#13;</h1>" + time),
    ]
    got = read(spark, pages, text_mode=mode)
    # a carriage return is not trimmed
    assert [r["title"] and r["title"].replace("\r", "") for r in got][:4] == titles[:4]
    assert got[4]["title"] == "\r\t\n c \r"
    assert got[2]["reason"] == "empty_title"


@pytest.mark.parametrize("mode", extract.TEXT_MODES)
def test_author(spark, mode):
    cases = {
        "<i class=by>Ann</i>": "Ann",
        "<i class=by><a href=/x>Ann</a> Lee</i>": "Ann",
        "<i class=by> <a href=/x>Ann</a></i>": "",
        "<i class=by></i>": None,
        "": None,
        "<i class=by>1</i><i class=by>2</i>": "1",
    }
    got = read(spark, [page(GOOD + inner) for inner in cases], text_mode=mode)
    assert [r["author"] for r in got] == list(cases.values())


def test_empty_description_is_not_null(spark):
    got = read(spark, [page(GOOD + "<p class=d> </p>"), page(GOOD + "<p class=d></p>"), page(GOOD)])
    assert [r["description"] for r in got] == ["", None, None]


def test_thumbnail_moves_first_and_asides_go(spark):
    image = '<img class=t src="i.png">'
    moved = '<img class="t" src="http://acme.tld/news/i.png"/>'
    cases = [
        (GOOD, f"x{image}y", moved + "xy"),
        (GOOD, f"x<aside>gone {image}</aside>y", moved + "xy"),
        (GOOD + '<p class="t">no image</p>' + image, "x", "x"),
        (GOOD, "x<aside>a<aside>b</aside></aside><div><script>s</script>y</div>", "x<div>y</div>"),
    ]
    got = read(spark, [page(inner, content) for inner, content, _ in cases])
    assert [r["content"] for r in got] == [expected for *_, expected in cases]


def test_links_become_absolute_and_bad_ones_stay(spark):
    hrefs = {
        "http://o.tld/x": "http://o.tld/x", "//h/p": "http://h/p", "/root": "http://acme.tld/root",
        "../up": "http://acme.tld/up", "?q": "http://acme.tld/news/1?q",
        "#f": "http://acme.tld/news/1?p=1#f", "": "http://acme.tld/news/1?p=1",
        "mailto:a@b.c": "mailto:a@b.c", "/é": "http://acme.tld/%C3%A9", "/%zz": "/%zz",
    }
    content = "".join(f'<a href="{h}">l</a>' for h in hrefs) + "<a>l</a><img><a name=n href=y>z</a>"
    (got,) = read(spark, [page(GOOD, content)])
    expected = "".join(f'<a href="{h}">l</a>' for h in hrefs.values())
    expected += '<a>l</a><img/><a name="n" href="http://acme.tld/news/y">z</a>'
    assert got["content"] == expected
    assert got["reason"] is None and len(got["warnings"]) == 1
    assert got["links"] == [*hrefs, "y"]


def test_bad_dates(spark):
    pages = [
        page(f"<h1>T</h1><time>{d}</time>") for d in ("31 February 2006", "soon", "", " 2 may 2006\n")
    ]
    got = read(spark, pages)
    assert [r["reason"] for r in got] == ["bad_date", "bad_date", "empty_date", None]
    assert [r["detail"] for r in got] == ["31 February 2006", "soon", None, None]
    got = read(spark, pages, on_bad_date="zero_date")
    assert [r["reason"] for r in got] == [None, None, "empty_date", None]
    assert got[0]["date"] == datetime.date(1, 1, 1)
    assert got[0]["warnings"] == ["bad_date: 31 February 2006"]


def test_a_broken_page_is_a_reject_row(spark):
    rows = spark.createDataFrame([(1, "a", "http://a.tld/", page(GOOD)), (2, "b", "http://b.tld/", page(GOOD))],
                                 "page_id long, website string, url string, html string")
    selectors = F.struct(F.lit("h1").alias("title"), F.lit(None).cast("string").alias("description"),
                         F.when(F.col("page_id") == 1, "p:hover").otherwise("body").alias("content"),
                         *[F.lit(v).cast("string").alias(n) for n, v in (("author", None), ("date", "h1"), ("thumbnail", None))])
    got = extract.read_pages_job(rows.withColumn("sel", selectors)).orderBy("page_id").collect()
    assert "unsupported selector" in got[0].parse_error and got[1].parse_error is None and got[1].n_content == 1


def test_large_pages_are_read_whole(spark):
    text = "lorem ipsum " * 200_000
    got = read(spark, [page(GOOD, text + f"<p>{i}</p>") for i in range(12)])
    assert [r["content"] for r in got] == [text + f"<p>{i}</p>" for i in range(12)]


def test_unknown_modes_are_refused(spark):
    with pytest.raises(ValueError):
        read(spark, [], text_mode="all")
    with pytest.raises(ValueError):
        read(spark, [], on_bad_date="guess")


def test_four_message_shapes(spark):
    rows = [("error", u, d) for u in (None, "http://x/") for d in (None, "why")]
    frame = spark.createDataFrame(rows, "kind string, u string, d string")
    got = frame.select(reports.reject_message(F.col("kind"), F.col("u"), F.col("d"))).collect()
    assert [r[0] for r in got] == [
        "Unknown error error", "error error: why",
        "Unknown error error on http://x/", "error error on http://x/: why",
    ]


def test_markup_is_not_read_for_columns_it_does_not_need(spark, tmp_path):
    path = str(tmp_path / "pages")
    spark.createDataFrame([(1, "acme", "http://acme.tld/", "x", "y")],
                          "page_id bigint, website string, url string, html string, extra string"
                          ).write.parquet(path)
    plan = read_articles(with_reading_rules(spark.read.parquet(path), sites_table(spark, [SITE])))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "extra" not in text


def test_a_thumbnail_that_is_the_content_ends():
    selectors = {"content": "img.c", "title": "h1", "date": "time", "thumbnail": "img.c"}
    got = extract._read_one("http://a.tld/", "<h1>T</h1><time>1</time><img class=c>", selectors, "first_text", True)
    assert got["content"] == "" and got["title_raw"] == "T"


def test_deep_text_is_found():
    selectors = {"content": "#c", "title": "h1", "date": "time"}
    page = "<h1>" + "<b><i>" * 3000 + "T</h1><time>1</time><div id=c>" + "<div>" * 3000 + "x"
    assert extract._read_one("http://a.tld/", page, selectors, "first_text", True)["title_raw"] == "T"
