import datetime
import xml.etree.ElementTree as ET
from email.utils import parsedate_to_datetime

import pytest

from newsloom.operators import feeds
from newsloom.sources.articles import ARTICLES_DDL

CONTENT = "{http://purl.org/rss/1.0/modules/content/}encoded"
ATOM = "{http://www.w3.org/2005/Atom}"
HARD = "<p class=\"x\">a & b</p> 'q' ]]> é😀\r\nnext\ttab"


def articles(spark):
    day = datetime.date(2024, 2, 3)
    rows = [
        ("a", "https://A.tld:81/1?x=1&y=2", "one <1>", None, HARD, None, day),
        ("a", "https://A.tld:81/0", "two", "", "c", "Ann & Co", day),
        ("a", "http://old.tld/9", "three", "about", "bad \x00\x0b￾ char", "", datetime.date(1, 1, 1)),
        ("b", "http://b.tld/p", "four", None, "", None, datetime.date(2023, 12, 31)),
    ]
    return spark.createDataFrame(rows, ARTICLES_DDL)


def test_headers_use_the_newest_article(spark):
    got = {tuple(r) for r in feeds.feed_headers(articles(spark)).collect()}
    assert got == {("a", "a", "https://A.tld:81"), ("b", "b", "http://b.tld")}


def test_rss_reads_back(spark):
    built = {r.website: r for r in feeds.build_feeds(articles(spark), 20, "rss").collect()}
    channel = ET.fromstring(built["a"].xml.encode()).find("channel")
    assert channel.findtext("title") == "a" and channel.findtext("link") == "https://A.tld:81"
    items = channel.findall("item")
    assert [i.findtext("link") for i in items] == [
        "https://A.tld:81/0", "https://A.tld:81/1?x=1&y=2", "http://old.tld/9"]
    assert [i.findtext("title") for i in items] == ["two", "one <1>", "three"]
    assert [i.findtext("description") for i in items] == ["", "", "about"]
    assert [i.findtext("author") for i in items] == ["Ann & Co", None, ""]
    assert items[1].findtext(CONTENT) == HARD
    assert items[2].findtext(CONTENT) == "bad ��� char"
    assert parsedate_to_datetime(items[0].findtext("pubDate")).date() == datetime.date(2024, 2, 3)
    assert built["a"].n_items == 3 and built["b"].n_items == 1


def test_atom_reads_back(spark):
    built = {r.website: r.xml for r in feeds.build_feeds(articles(spark), 2, "atom").collect()}
    feed = ET.fromstring(built["a"].encode())
    assert feed.findtext(f"{ATOM}title") == "a" and feed.findtext(f"{ATOM}updated") == "2024-02-03T00:00:00Z"
    entries = feed.findall(f"{ATOM}entry")
    assert [e.findtext(f"{ATOM}id") for e in entries] == ["https://A.tld:81/0", "https://A.tld:81/1?x=1&y=2"]
    assert entries[1].find(f"{ATOM}link").get("href") == "https://A.tld:81/1?x=1&y=2"
    assert entries[1].findtext(f"{ATOM}content") == HARD
    assert [e.findtext(f"{ATOM}author/{ATOM}name") for e in entries] == ["Ann & Co", None]


def test_spark_reads_the_documents_back(spark, tmp_path):
    path = str(tmp_path / "feeds")
    feeds.write_feeds(feeds.build_feeds(articles(spark), 20, "rss"), path)
    items = spark.read.option("rowTag", "item").xml(path + "/website=a")
    assert items.count() == 3


def test_unknown_websites_and_statistics(spark):
    requested = spark.createDataFrame([("a",), ("nope",), ("a",)], "website string")
    built = feeds.build_feeds(articles(spark), 1, "rss", requested)
    got = {r.website: (r.status, r.n_items, r.xml is None) for r in built.collect()}
    assert got == {"a": ("ok", 1, False), "nope": ("unknown", 0, True)}
    (stats,) = feeds.feed_stats(built, 1).collect()
    size = len(built.filter("website = 'a'").first().xml.encode())
    assert tuple(stats) == ("a", size, "rss", 1)


@pytest.mark.parametrize("kind, n", [("json", 5), ("rss", 0)])
def test_bad_settings(spark, kind, n):
    with pytest.raises(ValueError):
        feeds.build_feeds(articles(spark), n, kind)
