"""Feeds: latest articles of every website as RSS or Atom documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom.functions.text import xml_text
from newsloom.functions.urls import site_link
from newsloom.operators.store import latest_n
from newsloom.scratch import child_names, materialize, path_exists
from newsloom.sources.config import FeedSettings

# Date stamps of the two formats.
RSS_STAMP = "EEE, dd MMM yyyy HH:mm:ss xx"
ATOM_STAMP = "yyyy-MM-dd'T'HH:mm:ssXXX"
XML_HEAD = '<?xml version="1.0" encoding="UTF-8"?>'


def feed_items(articles: DataFrame, n: int) -> DataFrame:
    """Latest ``n`` articles per website as feed items, ``rn`` 1 being the newest."""
    return latest_n(articles, n).select(
        "website",
        "rn",
        "title",
        F.col("url").alias("link"),
        F.col("date").alias("created"),
        "content",
        F.coalesce("description", F.lit("")).alias("description"),
        "author",
    )


def feed_headers(articles: DataFrame) -> DataFrame:
    """Title and link of every feed: the website and the origin of its newest article."""
    newest = latest_n(articles.select("website", "url", "date"), 1)
    return newest.select("website", F.col("website").alias("title"), site_link(F.col("url")).alias("link"))


def _element(name: str, value: Column, attributes: str = "") -> Column:
    return F.concat(F.lit(f"<{name}{attributes}>"), value, F.lit(f"</{name}>"))


def _stamp(created: Column, pattern: str) -> Column:
    return F.date_format(created.cast("timestamp"), pattern)


def _rss_item(i: Column) -> Column:
    author = F.when(i["author"].isNull(), F.lit("")).otherwise(
        _element("author", xml_text(i["author"]))
    )
    return _element(
        "item",
        F.concat(
            _element("title", xml_text(i["title"])),
            _element("link", xml_text(i["link"])),
            _element("description", xml_text(i["description"])),
            _element("content:encoded", xml_text(i["content"])),
            author,
            _element("pubDate", _stamp(i["created"], RSS_STAMP)),
        ),
    )


def _atom_entry(i: Column) -> Column:
    author = F.when(i["author"].isNull(), F.lit("")).otherwise(
        _element("author", _element("name", xml_text(i["author"])))
    )
    link = xml_text(i["link"])
    return _element(
        "entry",
        F.concat(
            _element("title", xml_text(i["title"])),
            _element("updated", _stamp(i["created"], ATOM_STAMP)),
            _element("id", link),
            _element("content", xml_text(i["content"]), ' type="html"'),
            F.lit('<link href="'), link, F.lit('" rel="alternate"/>'),
            _element("summary", xml_text(i["description"]), ' type="html"'),
            author,
        ),
    )


def _rss(website: Column, link: Column, items: Column) -> Column:
    channel = F.concat(
        _element("title", xml_text(website)),
        _element("link", xml_text(link)),
        F.lit("<description></description>"),
        F.array_join(F.transform(items, lambda i: i["doc"]), ""),
    )
    head = XML_HEAD + '<rss version="2.0" xmlns:content="http://purl.org/rss/1.0/modules/content/">'
    return F.concat(F.lit(head), _element("channel", channel), F.lit("</rss>"))


def _atom(website: Column, link: Column, items: Column, updated: Column) -> Column:
    feed = F.concat(
        _element("title", xml_text(website)),
        _element("id", xml_text(link)),
        _element("updated", _stamp(updated, ATOM_STAMP)),
        F.lit('<link href="'), xml_text(link), F.lit('"/>'),
        # a feed without an author of its own must still name one
        _element("author", _element("name", xml_text(website))),
        F.array_join(F.transform(items, lambda i: i["doc"]), ""),
    )
    head = XML_HEAD
    return F.concat(F.lit(head), _element("feed", feed, ' xmlns="http://www.w3.org/2005/Atom"'))


def build_feeds(
    articles: DataFrame, n: int, kind: str = "rss", requested: DataFrame | None = None
) -> DataFrame:
    """One feed document per website, all websites in one job.

    Out: ``website``, ``status`` (``ok`` or ``unknown``), ``n_items``,
    ``feed_type``, ``xml``. With ``requested`` (column ``website``) exactly those
    websites are answered; one without stored articles is ``unknown``. Items are
    rendered before they are grouped, and a group holds at most ``n`` of them.
    """
    settings = FeedSettings(kind, n)
    render = _rss_item if settings.kind == "rss" else _atom_entry
    items = feed_items(articles, settings.n)
    rendered = items.select(
        "website",
        "rn",
        "created",
        F.when(F.col("rn") == 1, site_link(F.col("link"))).alias("link"),
        render({name: F.col(name) for name in items.columns}).alias("doc"),
    )
    grouped = rendered.groupBy("website").agg(
        F.array_sort(F.collect_list(F.struct("rn", "doc"))).alias("items"),
        F.max("link").alias("link"),
        F.max("created").alias("updated"),
    )
    columns = [F.col("website"), F.col("link"), F.col("items")]
    xml = _rss(*columns) if settings.kind == "rss" else _atom(*columns, F.col("updated"))
    feeds = grouped.select("website", F.size("items").alias("n_items"), xml.alias("xml"))
    if requested is not None:
        feeds = requested.select("website").distinct().join(feeds, "website", "left")
    return feeds.select(
        "website",
        F.when(F.col("xml").isNull(), "unknown").otherwise("ok").alias("status"),
        F.coalesce("n_items", F.lit(0)).alias("n_items"),
        F.lit(settings.kind).alias("feed_type"),
        "xml",
    )


def feed_stats(feeds: DataFrame, n: int) -> DataFrame:
    """What is logged per generated feed: size in bytes, type and item setting."""
    return feeds.filter(F.col("status") == "ok").select(
        "website",
        F.octet_length("xml").alias("content_length"),
        "feed_type",
        F.lit(n).alias("nb_items"),
    )


def write_feeds(feeds: DataFrame, path: str) -> None:
    """Feed sink: one text document per website directory."""
    (
        feeds.filter(F.col("status") == "ok")
        .select("website", F.col("xml").alias("value"))
        .write.mode("overwrite")
        .partitionBy("website")
        .option("lineSep", "\n")
        .text(path)
    )


def update_feeds(feeds: DataFrame, path: str) -> DataFrame:
    """Feed sink that writes the documents that have changed, each over its old one; out: their ``website``.

    Digests of what is there lie beside the documents, a generation for each update, and
    are written after them: an update that dies in between is made again. Documents of
    websites that ``feeds`` doesn't hold stay as they are.
    """
    spark = feeds.sparkSession
    built = feeds.filter(F.col("status") == "ok").select("website", F.col("xml").alias("value"), F.sha2("xml", 256).alias("digest"))
    built = materialize(built, "feeds")
    folder = f"{path.rstrip('/')}-digests"
    done = [int(n[4:]) for n in child_names(spark, folder) if path_exists(spark, f"{folder}/{n}/_SUCCESS")]
    known = spark.createDataFrame([], "website string, digest string")
    if done:
        known = spark.read.schema("website string, digest string").parquet(f"{folder}/gen={max(done)}")
    changed = built.join(known, ["website", "digest"], "left_anti")
    if changed.isEmpty():
        return changed.select("website")
    changed = materialize(changed, "changed-feeds")
    writer = changed.select("website", "value").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("website").option("lineSep", "\n").text(path)
    kept = known.join(built, "website", "left_anti").unionByName(built.select("website", "digest"))
    kept.write.mode("overwrite").parquet(f"{folder}/gen={max(done, default=0) + 1}")
    return changed.select("website")


def read_feeds(spark: SparkSession, path: str) -> DataFrame:
    """(website, xml): the documents of a feed sink."""
    written = spark.read.schema("value string, website string").text(path, wholetext=True)
    return written.select("website", F.regexp_replace("value", "\n\\z", "").alias("xml"))
