import re

import pytest
from pyspark.sql import functions as F

from newsloom.operators import frontier, store
from newsloom.plans.ingest import run_ingest
from newsloom.scratch import touch
from newsloom.sources import articles as articles_module
from newsloom.sources import url_index
from newsloom.sources.articles import IndexedStore, ParquetStore
from newsloom.sources.url_index import UrlIndex, bucket_of

from test_ingest import PAGES, SITES, pages, sites_table, stored


def urls(spark, first, last, site="a"):
    return spark.range(first, last).select(F.lit(site).alias("website"), F.concat(F.lit("http://x/"), "id").alias("url"))


def held(index, rows, keys=("website", "url")):
    return sorted(tuple(r) for r in index.holding(rows, list(keys)).collect())


@pytest.mark.parametrize("broadcast", [200_000, 0])
def test_look_ups(spark, tmp_path, monkeypatch, broadcast):
    monkeypatch.setattr(url_index, "BROADCAST_ROWS", broadcast)
    index = UrlIndex(spark, str(tmp_path / "i"), buckets=8)
    asked = urls(spark, 0, 2000).unionByName(urls(spark, 90, 110, "b")).unionByName(spark.createDataFrame([("a", None)], "website string, url string"))
    assert held(index, asked) == [] and index.count() == 0
    index.append(urls(spark, 100, 300))
    index.append(urls(spark, 500, 600).unionByName(urls(spark, 100, 105, "b")))
    index.append(urls(spark, 0, 0))
    expected = {("a", f"http://x/{i}") for i in [*range(100, 300), *range(500, 600)]} | {("b", f"http://x/{i}") for i in range(100, 105)}
    assert held(index, asked) == sorted(expected) and index.count() == 305
    renamed = asked.withColumnRenamed("url", "canonical_url")
    assert held(index, renamed, ("website", "canonical_url")) == sorted(expected)
    assert held(index, asked, ("url",)) == sorted({(u,) for _, u in expected})
    index.merge()
    assert held(index, asked) == sorted(expected) and len({r.append for r in index.shapes()}) == 1
    index.append(urls(spark, 1990, 1995))
    index.vacuum()
    assert index.count() == 310 and len(held(index, asked)) == 310
    # Another handle reads the same layout, whatever it asks for.
    assert UrlIndex(spark, index.path, buckets=99).count() == 310


def test_filters_spare_most_keys(spark, tmp_path):
    index = UrlIndex(spark, str(tmp_path / "i"), buckets=4)
    index.append(urls(spark, 0, 20_000))
    asked = urls(spark, 20_000, 40_000)
    maybe = index.maybe_stored(asked, "url", index.shapes(), True).count()
    assert maybe < 0.05 * 20_000
    assert index.maybe_stored(urls(spark, 0, 20_000), "url", index.shapes(), True).count() == 20_000


def test_only_buckets_of_the_urls_are_read(spark, tmp_path):
    index = UrlIndex(spark, str(tmp_path / "i"), buckets=64)
    index.append(urls(spark, 0, 5000))
    asked = urls(spark, 3, 6)
    wanted = {r[0] for r in asked.select(bucket_of(F.col("url"), 64)).collect()}
    found = index.holding(asked, ["website", "url"])
    assert found.count() == 3
    opened = {int(re.search(r"bucket=(\d+)", f)[1]) for f in found.inputFiles() if "/keys/" in f}
    assert opened == wanted and len(wanted) <= 3


def test_merges_by_itself(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(url_index, "LIVE_APPENDS", 3)
    index = UrlIndex(spark, str(tmp_path / "i"), buckets=4)
    for k in range(8):
        index.append(urls(spark, 10 * k, 10 * k + 10))
        assert len({r.append for r in index.shapes()}) <= 4
    assert len(held(index, urls(spark, 0, 200))) == 80


def test_decisions_and_claims(spark, tmp_path):
    index = UrlIndex(spark, str(tmp_path / "i"))
    known = urls(spark, 0, 50)
    index.append(known)
    checked = urls(spark, 40, 60).select(
        F.monotonically_increasing_id().alias("page_id"), "website", "url", F.col("url").alias("canonical_url"), F.lit(0).alias("max_visits"), F.lit(None).cast("string").alias("failed"))
    by = lambda s: sorted((r.url, r.reason) for r in frontier.decide(checked, s).collect())
    assert by(index) == by(known) and sum(r == "stored" for _, r in by(index)) == 10
    rows = urls(spark, 45, 55, "other").withColumn("seq", F.col("url"))
    claims = lambda s: sorted(r.seq for r in store.first_claims(rows, s, "seq").collect())
    assert claims(index) == claims(known) and len(claims(index)) == 5


def test_runs_read_no_article(spark, tmp_path, monkeypatch):
    sites = sites_table(spark, SITES)
    plain, indexed = ParquetStore(spark, str(tmp_path / "a")), IndexedStore(spark, str(tmp_path / "b"))
    for rows in (PAGES[:6], PAGES):
        for articles in (plain, indexed):
            with monkeypatch.context() as m:
                if articles is indexed:
                    m.setattr(articles_module.ParquetStore, "read", lambda self: pytest.fail("articles were read"))
                run_ingest(spark, pages(spark, rows), sites, articles, str(tmp_path / "r"))
    assert stored(indexed) == stored(plain) != {} and indexed.index.count() == plain.read().count()


def test_an_append_that_died(spark, tmp_path, monkeypatch):
    articles = IndexedStore(spark, str(tmp_path / "a"))
    made = urls(spark, 0, 5).selectExpr("website", "url", "'t' AS title", "'d' AS description", "'c' AS content", "'x' AS author", "DATE '2024-01-01' AS date")
    articles.append(made)
    more = made.withColumn("url", F.concat("url", F.lit("/more")))
    monkeypatch.setattr(UrlIndex, "append", lambda self, keys: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        articles.append(more)
    monkeypatch.undo()
    again = IndexedStore(spark, articles.path)
    assert again.index.count() == 5
    assert again.known().count() == 10 and again.known().count() == 10
    # A store that had no index gets one.
    late = IndexedStore(spark, articles.path, str(tmp_path / "late"))
    assert late.known().count() == 10
    touch(spark, f"{late.index_path}/appending")
    assert len(held(late.known(), more)) == 5
