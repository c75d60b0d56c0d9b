import pytest
from pyspark.sql import functions as F

from newsloom.operators import frontier
from newsloom.plans import ingest
from newsloom.scratch import child_names, scratch_root
from newsloom.sources.articles import ParquetStore
from newsloom.sources.config import sites_table
from newsloom.streaming.ingest_stream import ingest_landing
from test_ingest import PAGES, pages, stored
from test_link_state import FREE


def reads(spark, name):
    """URLs in the read stages of a stream's runs."""
    root = scratch_root(spark)
    found = []
    for folder in child_names(spark, root):
        if folder.startswith(f"newsloom-run-{name}-"):
            found += [r.url for r in spark.read.parquet(f"{root}/{folder}/read").select("url").collect()]
    return found


def test_each_url_is_read_once(spark, tmp_path, monkeypatch):
    sites, articles = sites_table(spark, FREE), ParquetStore(spark, str(tmp_path / "a"))
    landing, rejects = str(tmp_path / "in"), str(tmp_path / "r")
    call = lambda: ingest_landing(spark, landing, sites, articles, rejects, str(tmp_path / "c"), "seen", remember="10 days")
    bad = (20, "no url at all", "<p>x")
    batches = [PAGES[:6], PAGES[4:10], PAGES[4:10] + [bad], [], PAGES + [(1000 + r[0], r[1] + "#again", r[2]) for r in PAGES] + [bad]]
    for k, rows in enumerate(batches):
        pages(spark, rows).coalesce(1).write.mode("append").parquet(landing)
        if k == 1:  # dies after reading, and is repeated
            with monkeypatch.context() as m:
                m.setattr(ParquetStore, "append", lambda self, a: (_ for _ in ()).throw(RuntimeError("lost")))
                with pytest.raises(Exception):
                    call()
        call()
    once = reads(spark, "seen")
    assert len(once) == len(set(once)) and "http://zeta.tld/a" in once and "http://acme.tld/news/3" in once
    whole = ParquetStore(spark, str(tmp_path / "whole"))
    ingest.run_ingest(spark, pages(spark), sites, whole, str(tmp_path / "wr"))
    assert stored(articles) == stored(whole) and articles.read().count() == len(stored(whole))
    told = spark.read.parquet(rejects)
    assert told.filter("page_url LIKE 'http://zeta.tld/a%' AND reason = 'seen'").count() >= 2
    assert told.filter("reason = 'not_article'").count() == 1


def test_forgotten_without_remember(spark, tmp_path):
    sites, articles = sites_table(spark, FREE), ParquetStore(spark, str(tmp_path / "a"))
    for _ in range(2):
        pages(spark, PAGES[8:9]).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        ingest_landing(spark, str(tmp_path / "in"), sites, articles, str(tmp_path / "r"), str(tmp_path / "c"), "unseen")
    assert reads(spark, "unseen") == ["http://zeta.tld/a"] * 2
    assert spark.read.parquet(str(tmp_path / "r")).filter(F.col("reason") == "seen").isEmpty()


def test_fresh_keys_meet_pages_under_the_salts_that_these_have(spark):
    rows = [(i, "w", f"u{i % 50}", None, "restrict" if i == 3 else None) for i in range(200)] + [(500, "w", None, None, None), (501, None, "u1", None, None)]
    checked = spark.createDataFrame(rows, "page_id long, website string, url string, canonical_url string, failed string")
    fresh = spark.createDataFrame([("w", f"u{i}") for i in range(0, 80, 2)] + [("w", "")], "website string, key string")
    marked = frontier.mark_seen(checked, fresh)
    told = {r.page_id: r.failed for r in marked.collect()}
    wanted = {i: "restrict" if i == 3 else "seen" if i % 2 else None for i in range(200)}
    assert told == {**wanted, 500: None, 501: "seen"} and marked.count() == 202
    # Copies of every fresh key for all salts hide from the planner how large that side is.
    assert "Generate" not in marked._jdf.queryExecution().analyzed().toString()
