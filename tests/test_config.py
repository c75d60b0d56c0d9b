import contextlib
import io

import pytest
from pyspark.sql import functions as F

from newsloom.sources.articles import article_store
from newsloom.sources.config import (
    ConfigError,
    FeedSettings,
    Site,
    parse_settings,
    settings_error,
    sites_table,
)
from newsloom.sources.pages import join_rules

SITE = {
    "website": "acme",
    "start_point": "http://acme.tld/",
    "selectors": {"title": "#a h1", "content": "#a #c", "date": "#a time"},
    "date_format": "{MONTH_NUM}-{DAY_NUM}-{YEAR_LONG}",
}
YAML = """
websites:
  - identifier: acme
    start_point: {start}
    selectors: {{title: "#a h1", content: "#a #c", date: "#a time", thumbnail: "img.t"}}
    date_format: "{{MONTH_NUM}}-{{DAY_NUM}}-{{YEAR_LONG}}"
    max_visits: 200
    {query}
    filters: {{restrict: "^http://acme.tld/news", exclude: ""}}
database: {{driver: {driver}, connection_data: x}}
feeds: {{type: {feed}, nb_items: {n}, interface: 127.0.0.1, port: 8888}}
"""


def text(start="http://acme.tld/", query="", driver="parquet", feed="rss", n=20):
    return YAML.format(start=start, query=query, driver=driver, feed=feed, n=n)


def test_whole_file():
    got = parse_settings(text(query="query: {ignore_all: true, except: [news, item]}"))
    site = got.sites[0]
    assert (site.website, site.max_visits, site.ignore_all) == ("acme", 200, True)
    assert site.listed_keys == ("news", "item")
    assert site.restrict == "^http://acme.tld/news" and not site.exclude
    assert site.row()[-1] is None  # an empty filter is no filter
    assert got.feeds == FeedSettings("rss", 20)
    assert got.driver == "parquet" and got.connection_data == "x"


def test_both_spellings_of_the_query_rule():
    assert parse_settings(text(query="ignore: {ignore_all: true}")).sites[0].ignore_all is True
    assert parse_settings(text()).sites[0].ignore_all is None
    with pytest.raises(ConfigError, match="not both"):
        parse_settings(text(query="ignore: {ignore_all: true}\n    query: {ignore_all: true}"))


@pytest.mark.parametrize(
    "change, message",
    [
        (dict(start="'not a url'"), "start point 'not a url'"),
        (dict(start="ftp://acme.tld/"), "no http or https URL"),
        (dict(query="query: {ignore_all: true, except: news item}"), "must be a list"),
        (dict(driver="oracle"), "not in 'oracle'"),
        (dict(feed="json"), "not 'json'"),
        (dict(n=0), "nb_items"),
    ],
)
def test_file_errors(change, message):
    with pytest.raises(ConfigError, match=message):
        parse_settings(text(**change))


@pytest.mark.parametrize(
    "change, message",
    [
        (dict(website=""), "identifier"),
        (dict(date_format="{DAY_NUM} {MONTH_LONG}"), "no year"),
        (dict(selectors={"title": "h1", "content": "p"}), "no date selector"),
        (dict(selectors={**SITE["selectors"], "title": "p:hover"}), "unsupported selector"),
        (dict(selectors={**SITE["selectors"], "topic": "p"}), "unknown selector"),
        (dict(restrict="(?=x)"), "unsupported construct"),
        (dict(restrict=r"(a)\1"), "unsupported construct"),
        (dict(exclude="(?<!x)y"), "unsupported construct"),
        (dict(max_visits=-1), "max_visits"),
    ],
)
def test_site_errors(change, message):
    with pytest.raises(ConfigError, match=message):
        Site(**{**SITE, **change})


def test_patterns_are_tried_by_the_engine_that_runs_them(spark):
    sites = [Site(**{**SITE, "restrict": "(?P<part>news)"}), Site(**{**SITE, "website": "b", "exclude": r"\(\?P<x"})]
    rows = {r.website: r for r in sites_table(spark, sites).collect()}
    assert rows["acme"].restrict == "(?<part>news)" and rows["b"].exclude == r"\(\?P<x"
    for wrong in ("(", "[z-a]", "a{2,1}"):
        with pytest.raises(ConfigError, match="site 'c'.*compile"):
            sites_table(spark, [*sites, Site(**{**SITE, "website": "c", "restrict": wrong})])
    with pytest.raises(ConfigError, match="more than once"):
        sites_table(spark, [sites[0], sites[0]])


def test_sites_are_broadcast_by_their_bytes(spark):
    few = sites_table(spark, [Site(**SITE)])
    many = sites_table(spark, [Site(**{**SITE, "website": f"s{i}", "restrict": "x" * 2000}) for i in range(10_001)])
    rows = spark.range(3000).selectExpr("id AS page_id", "CASE WHEN id % 3 = 0 THEN 's7' ELSE 's' || id END AS website", "'u' AS url")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10k")

    def plan(joined):
        with contextlib.redirect_stdout(io.StringIO()) as out:
            joined.explain()
        return out.getvalue()

    joined = join_rules(rows, many, "website", F.col("page_id"))
    assert "BroadcastHashJoin" in plan(join_rules(rows, few, "website", F.col("page_id")))
    assert "SortMergeJoin" in plan(joined) and "_salt" in plan(joined) and joined.count() == 3000
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_the_store_that_a_configuration_names(spark, tmp_path):
    settings = parse_settings(text().replace("connection_data: x", f"connection_data: {tmp_path}/articles"))
    assert article_store(spark, settings).path == f"{tmp_path}/articles"
    with pytest.raises(ValueError, match="connection_data"):
        article_store(spark, parse_settings("websites: []"))


def test_settings_in_a_table_are_judged_like_files(spark):
    good = "websites:\n- identifier: a\n  start_point: http://a.tld/\n  date_format: '{YEAR_LONG}-{MONTH_NUM}-{DAY_NUM}'\n  selectors: {title: h1, content: article, date: time}\n"
    texts = [good, "", None, good.replace("http:", "gopher:"), "a: [", "- 1", "websites: text", good + "feeds: {type: rss}\n", good + "database: {driver: x}\n"]
    rows = spark.createDataFrame([*enumerate(texts)], "i int, settings string")
    told = dict(tuple(r) for r in rows.select("i", settings_error(F.col("settings"))).collect())
    assert [i for i, e in told.items() if e is None] == [0, 1, 2]
    parts = {3: "gopher", 4: "no YAML", 5: "mapping", 6: "another form", 7: "nb_items", 8: "not in 'x'"}
    assert all(part in told[i] for i, part in parts.items())
