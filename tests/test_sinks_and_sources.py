import os

import pytest
from pyspark.sql import functions as F

from newsloom.operators import feeds
from newsloom.operators.latest import ARTICLES_DDL
from newsloom.plans.ingest import run_ingest
from newsloom.sources.articles import ParquetStore
from newsloom.sources.config import sites_table
from newsloom.sources.pages import read_pages, unreadable_files
from test_ingest import PAGES, pages, stored
from test_latest import made
from test_link_state import FREE


def files(path):
    return {f"{d}/{n}": os.stat(f"{d}/{n}").st_ino for d, _, names in os.walk(path) for n in names if n.endswith(".txt")}


def test_only_changed_feeds_are_written(spark, tmp_path):
    path = str(tmp_path / "f")
    first = spark.createDataFrame(made(1, 200, 20), ARTICLES_DDL)
    more = spark.createDataFrame([(w, f"http://x/new/{w}", "new", None, "c", None, r[6]) for w, r in zip(("w3", "w7", "w9"), made(2, 3))], ARTICLES_DDL)
    more = more.withColumn("date", F.lit("2030-01-01").cast("date"))
    every = first.unionByName(more)
    build = lambda a: feeds.build_feeds(a, 4, "rss")
    assert feeds.update_feeds(build(first), path).count() == 20
    before = files(path)
    assert feeds.update_feeds(build(first), path).isEmpty() and files(path) == before
    changed = feeds.update_feeds(build(every), path)
    assert sorted(r.website for r in changed.collect()) == ["w3", "w7", "w9"]
    after = files(path)
    assert len(after) == 20 and len(set(after.items()) - set(before.items())) == 3
    read = lambda: {r.website: r.xml for r in feeds.read_feeds(spark, path).collect()}
    expected = {r.website: r.xml for r in build(every).collect()}
    assert read() == expected
    # Documents of some websites only: the others stay.
    assert feeds.update_feeds(build(first.filter("website = 'w3'")), path).count() == 1
    assert {w for w, x in read().items() if x != expected[w]} == {"w3"} and len(read()) == 20


def test_an_update_that_died_is_made_again(spark, tmp_path):
    path = str(tmp_path / "f")
    built = feeds.build_feeds(spark.createDataFrame(made(1, 30, 3), ARTICLES_DDL), 2, "atom")
    # Documents without their digests.
    feeds.write_feeds(built, path)
    assert feeds.update_feeds(built, path).count() == 3 and feeds.update_feeds(built, path).isEmpty()


def test_unreadable_files_are_named_and_the_rest_is_stored(spark, tmp_path):
    landing = str(tmp_path / "in")
    for rows in (PAGES[:5], PAGES[5:9], PAGES[9:], []):
        pages(spark, rows).coalesce(1).write.mode("append").parquet(landing)
    names = sorted(n for n in os.listdir(landing) if n.endswith(".parquet"))
    whole = next(n for n in names if spark.read.parquet(f"{landing}/{n}").filter("page_id = 13").count())
    with open(f"{landing}/{whole}", "rb") as f:
        data = f.read()
    with open(f"{landing}/broken.parquet", "wb") as f:
        f.write(data[: len(data) // 2])
    with pytest.raises(Exception):
        read_pages(spark, landing).count()
    lost = unreadable_files(spark, landing)
    articles = ParquetStore(spark, str(tmp_path / "a"))
    run = run_ingest(spark, read_pages(spark, landing, skip_unreadable=True), sites_table(spark, FREE), articles, str(tmp_path / "r"), lost=lost)
    told = run.rejects.filter("reason = 'unreadable_file'").collect()
    assert [(r.website, r.kind, os.path.basename(r.page_url)) for r in told] == [(None, "source", "broken.parquet")]
    assert told[0].detail.startswith(f"{len(data) // 2} bytes")
    plain = ParquetStore(spark, str(tmp_path / "plain"))
    run_ingest(spark, pages(spark), sites_table(spark, FREE), plain, str(tmp_path / "r2"))
    assert stored(articles) == stored(plain) != {}


def test_no_file_is_lost(spark, tmp_path):
    pages(spark).write.parquet(str(tmp_path / "in"))
    assert unreadable_files(spark, str(tmp_path / "in")).isEmpty()
