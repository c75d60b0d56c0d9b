"""Inputs for the registered queries, derived by Spark from the given tables.

``documents`` become articles and pages of 20 news sites (one per source):
odd pages, missing fields, copies and bad dates follow from properties of the
documents. ``pages`` are used as they are, the host being the website.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from newsloom.functions import urls
from newsloom.functions.dates import translate_layout
from newsloom.functions.text import escape_markup, first_line, trim_field
from newsloom.plans.ingest import reading_tasks, spread
from newsloom.scratch import materialize

DOC_SITES = 20
DOC_DATE_FORMAT = "{DAY_NUM} {MONTH_LONG} {YEAR_LONG}"
DOC_SELECTORS = {
    "title": "#main-article h1",
    "description": "#main-article #description",
    "content": "#main-article #content",
    "author": "#main-article #author",
    "date": "#main-article time",
    "thumbnail": "#main-article img.thumbnail",
}
PAGE_SELECTORS = {"title": "article h1", "content": "article", "date": "nav a"}


def read_partitions(spark: SparkSession) -> int:
    """The given tables are single files; markup made from them is read by all cores."""
    return 2 * spark.sparkContext.defaultParallelism


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def selector_struct(selectors: dict[str, str]) -> Column:
    names = ("title", "description", "content", "author", "date", "thumbnail")
    return F.struct(*[F.lit(selectors.get(n)).cast("string").alias(n) for n in names])


def with_rules(
    rows: DataFrame,
    ignore_all: bool | None = None,
    listed: tuple[str, ...] = (),
    restrict: str | None = None,
    exclude: str | None = None,
    max_visits: int = 0,
) -> DataFrame:
    """Give every row the same site rules, as literal columns."""
    keys = F.array(*[F.lit(k) for k in listed]).cast("array<string>")
    return rows.withColumns(
        {
            "ignore_all": F.lit(ignore_all).cast("boolean"),
            "listed_keys": keys,
            "restrict": F.lit(restrict).cast("string"),
            "exclude": F.lit(exclude).cast("string"),
            "max_visits": F.lit(max_visits),
        }
    )


def settings_texts(pages: DataFrame) -> DataFrame:
    """(page_id, settings): a settings text for each page. By page_id they are right (0, 1), start at an ftp
    URL (2), ask for an unknown type of feed (3) or for no items (4), or lack the date selector (5)."""
    kind = F.col("page_id") % 6
    start = F.when(kind == 2, F.regexp_replace("url", "^https?:", "ftp:")).otherwise(F.col("url"))
    site = F.format_string(
        "websites:\n- identifier: site%d\n  start_point: '%s'\n  date_format: '%s'\n  selectors:\n    title: h1\n    content: article\n",
        F.col("page_id"),
        F.replace(start, F.lit("'"), F.lit("''")),
        F.lit(DOC_DATE_FORMAT),
    )
    date = F.when(kind == 5, "").otherwise("    date: time\n")
    feed = F.when(kind == 3, "json").when(kind == 1, "atom").otherwise("rss")
    feeds = F.format_string("feeds:\n  type: %s\n  nb_items: %d\n", feed, F.when(kind == 4, 0).otherwise(20))
    return pages.select("page_id", F.concat(site, date, feeds).alias("settings"))


def host_pages(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return pages.select(urls.host(F.col("url")).alias("website"), "page_id", "url", *columns)


def host_versions(pages: DataFrame, day: Column, restrict: str, exclude: str) -> DataFrame:
    """Five versions of the rules of every host, ten days apart: without filters, from the second with a
    restriction, from the fourth with exclusions too."""
    sites = pages.select("website").distinct().withColumn("v", F.explode(F.sequence(F.lit(0), F.lit(4))))
    begins = F.date_add(day, (F.col("v") * 10 + F.octet_length("website") % 7).cast("int"))
    none = F.lit(None).cast("string")
    return with_rules(sites.withColumn("valid_from", begins), ignore_all=True).withColumns(
        {
            "restrict": F.when(F.col("v") >= 1, F.lit(restrict)).otherwise(none),
            "exclude": F.when(F.col("v") >= 3, F.lit(exclude)).otherwise(none),
        }
    )


def documents_of_sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with what an article needs."""
    lang, number = F.col("lang"), F.col("doc_id").cast("string")
    return table(spark, sf_dir, "documents").select(
        "doc_id",
        "lang",
        "text",
        "n_chars",
        F.col("source").alias("website"),
        F.concat(F.lit("https://"), "source", F.lit(".example.com/news/"), number).alias("url"),
        trim_field(first_line(F.col("text"))).alias("title"),
        F.when(lang == "de", None)
        .when(lang == "es", "")
        .otherwise(F.concat(F.lit("Summary of "), number))
        .alias("description"),
        F.when(lang == "fr", None).otherwise(F.concat(F.lit("Desk "), lang)).alias("author"),
        F.date_add(F.lit("2024-01-01").cast("date"), (F.col("n_chars") % 365).cast("int")).alias(
            "date"
        ),
    )


def doc_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return documents_of_sites(spark, sf_dir).select(
        "website", "url", "title", "description", F.col("text").alias("content"), "author", "date"
    )


def doc_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as markup, spread for reading since the tables are few files; see ``as_pages``."""
    docs = documents_of_sites(spark, sf_dir)
    return as_pages(spread(docs, reading_tasks(docs), "doc_id"))


def as_pages(docs: DataFrame) -> DataFrame:
    """Documents as markup: ``page_id``, ``website``, ``url``, ``html``.

    Short documents have no date, documents with a bar have an impossible one.
    Documents of a site form a binary tree of links with links back to the
    parent; German pages do not link to their children. Some pages end in markup that
    is nested 2,000 deep, some in 600 paragraphs that each leave a tag open.
    """
    title, lang = escape_markup(F.col("title")), F.col("lang")
    place = F.floor(F.col("doc_id") / DOC_SITES)
    member = F.col("doc_id") % DOC_SITES

    def link(k: Column) -> Column:
        to = (k * DOC_SITES + member).cast("string")
        return F.concat(F.lit('<a href="/news/'), to, F.lit('#from-nav">'), to, F.lit("</a>"))

    children = F.concat(link(place * 2 + 1), link(place * 2 + 2))
    parent = link(F.floor((place - 1) / 2))
    nav = F.concat(
        F.when(lang == "de", "").otherwise(children), F.when(place == 0, "").otherwise(parent)
    )
    description = F.when(lang == "de", "").otherwise(
        F.concat(F.lit('<p id="description"> '), "description", F.lit("\n</p>"))
    )
    author = (
        F.when(lang == "fr", "")
        .when(lang == "es", '<span id="author"><a href="/desk/es">Desk es</a></span>')
        .otherwise(F.concat(F.lit('<span id="author">\tDesk '), lang, F.lit("\n</span>")))
    )
    printed = F.when(F.contains("text", F.lit("|")), "31 February 2024").otherwise(
        F.date_format("date", "d MMMM yyyy")
    )
    time = F.when(F.col("n_chars") < 300, "").otherwise(
        F.concat(F.lit("<time> "), printed, F.lit("\n</time>"))
    )
    number = F.col("doc_id").cast("string")
    bad_link = F.when(lang == "fr", '<a href="/%zz">bad</a>').otherwise("")
    html = F.concat(
        F.lit("<!DOCTYPE html><html><head><title>"), title,
        F.lit('</title><script>var t="</div>";</script></head><body><nav>'), nav,
        F.lit('</nav><article id="main-article"><h1> \n'), title, F.lit("\t</h1>"),
        description, author, time,
        F.lit('<div id="content"><script>if (1 < 2) track();</script>'),
        escape_markup(F.col("text")),
        F.lit('<aside><p>Also <a href="/x">read</a><script>a()</script></aside>'),
        F.lit('<a href="../more?id='), number, F.lit('#top">more</a>'), bad_link,
        F.lit('</div><img class="thumbnail" src="/img/'), number,
        F.lit('.png"></article>'), odd_end(F.col("doc_id")), F.lit("</body></html>"),
    )
    return docs.select(F.col("doc_id").alias("page_id"), "website", "url", html.alias("html"))


def odd_end(number: Column) -> Column:
    fonts = F.transform(
        F.sequence(F.lit(1), F.lit(600)), lambda i: F.concat(F.lit('<p><font color="c'), i.cast("string"), F.lit('">x'))
    )
    return (
        F.when(number % 50 == 7, F.repeat(F.lit("<div>"), F.lit(2000)))
        .when(number % 50 == 19, F.array_join(fonts, ""))
        .otherwise("")
    )


def doc_sites(spark: SparkSession, sf_dir: str, max_visits: int = 0) -> DataFrame:
    """One site per document source, rules as in a configuration file."""
    layout = translate_layout(DOC_DATE_FORMAT)
    sources = table(spark, sf_dir, "documents").select(F.col("source").alias("website")).distinct()
    start = F.concat(
        F.lit("https://"), "website", F.lit(".example.com/news/"), F.substring("website", 4, 10)
    )
    return with_rules(
        sources.withColumns(
            {
                "start_point": start,
                "sel": selector_struct(DOC_SELECTORS),
                "date_pattern": F.lit(layout.pattern),
                "date_rewrite": F.lit(layout.rewrite),
            }
        ),
        ignore_all=True,
        restrict="/news/",
        max_visits=max_visits,
    )


def doc_archives(spark: SparkSession, sf_dir: str, pages_each: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(sites, edges, pages): the documents of a site as one long archive, ``pages_each`` pages for a document.

    Every page links to the next. By the number of the site, the start also links to
    the middle (1), the link there is missing (2), or the last page links to the
    middle (3).
    """
    docs = documents_of_sites(spark, sf_dir).select("website", "doc_id", "url")
    # Places by site: documents are ranked, and each has as many pages. Documents are joined, and
    # their pages follow from that in place.
    ranked = docs.withColumn("rank", F.row_number().over(Window.partitionBy("website").orderBy("doc_id")) - 1)
    ranked = docs.join(ranked.select("doc_id", "rank"), "doc_id").select("website", "url", F.col("rank").cast("long").alias("rank"))
    ranked = materialize(ranked, "archive")
    ends = ranked.groupBy("website").agg((F.count("*") * pages_each).alias("n"))
    kind, half = F.substring("website", 4, 10).cast("int") % 4, F.floor(F.col("n") / 2)
    page = lambda url, p: F.concat(url, F.lit("?page="), p.cast("string"))
    steps = ranked.join(ends, "website").select(
        "website",
        "url",
        "rank",
        F.when(kind == 2, half - 1).alias("last"),
        F.when(kind == 1, F.lit(0)).when(kind == 3, F.col("n") - 1).alias("leap"),
        half.alias("half"),
    )
    to = ranked.select("website", F.col("url").alias("to"), F.col("rank").alias("to_rank"))
    following = (
        steps.withColumn("to_rank", F.explode(F.array("rank", F.col("rank") + 1)))
        .join(to, ["website", "to_rank"])
        .withColumn(
            "p",
            F.explode(
                F.when(F.col("to_rank") > F.col("rank"), F.array(F.lit(pages_each - 1))).otherwise(
                    F.slice(F.sequence(F.lit(0), F.lit(pages_each - 1)), 1, pages_each - 1)
                )
            ),
        )
        .filter(~F.coalesce(F.col("rank") * pages_each + F.col("p") == F.col("last"), F.lit(False)))
        .select("website", page(F.col("url"), F.col("p")).alias("from_url"), page(F.col("to"), (F.col("p") + 1) % pages_each).alias("to_url"))
    )
    leaps = (
        steps.filter(F.floor(F.col("leap") / pages_each) == F.col("rank"))
        .withColumn("to_rank", F.floor(F.col("half") / pages_each))
        .join(to, ["website", "to_rank"])
        .select(
            "website", page(F.col("url"), F.col("leap") % pages_each).alias("from_url"), page(F.col("to"), F.col("half") % pages_each).alias("to_url")
        )
    )
    first = ranked.filter("rank = 0").select("website", page(F.col("url"), F.lit(0)).alias("start_point"))
    numbers = F.explode(F.sequence(F.lit(0), F.lit(pages_each - 1)))
    pages = ranked.withColumn("p", numbers).select("website", page(F.col("url"), F.col("p")).alias("url"))
    return with_rules(first), following.unionByName(leaps), pages


def doc_pages_with_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Document pages plus a second copy of every Spanish page under another URL."""
    # A run spreads the pages that it reads: here the scan's own splits do, and no text is shuffled.
    docs = documents_of_sites(spark, sf_dir)
    spanish = table(spark, sf_dir, "documents").filter(F.col("lang") == "es").select("doc_id")
    pages = as_pages(docs)
    copies = as_pages(docs.join(spanish, "doc_id", "left_semi")).select(
        (F.col("page_id") + (1 << 40)).alias("page_id"),
        "website",
        F.concat("url", F.lit("?copy=1#top")).alias("url"),
        "html",
    )
    return pages.unionByName(copies)
