import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from newsloom.operators import feeds
from newsloom.operators.latest import ARTICLES_DDL, LatestArticles
from newsloom.operators.store import latest_n
from newsloom.plans.ingest import run_ingest
from newsloom.sources.articles import ParquetStore
from test_ingest import PAGES, SITES, pages, sites_table


def made(seed, n, sites=9):
    rng = random.Random(seed)
    return [
        (f"w{rng.randrange(sites)}", f"http://x/{seed}/{i}", f"t{i}", None, "c", rng.choice([None, "a"]), date(2024, 1, 1) + timedelta(days=rng.randrange(40)))
        for i in range(n)
    ]


def rows(frame):
    return sorted(tuple(r) for r in frame.select("website", "rn", "url", "date").collect())


def test_five_batches(spark, tmp_path, monkeypatch):
    kept, every = LatestArticles(spark, str(tmp_path / "l"), 4, buckets=4), []
    monkeypatch.setattr(ParquetStore, "read", lambda self: pytest.fail("the store was read"))
    for seed, (n, sites) in enumerate([(60, 9), (40, 9), (1, 1), (0, 1), (50, 12)]):
        batch = spark.createDataFrame(made(seed, n, sites), ARTICLES_DDL)
        before = kept.current()
        kept.update(batch)
        kept.update(batch)  # merged again: no change
        hit = {r[0] for r in batch.select(kept._bucket()).distinct().collect()}
        assert {b: g for b, g in kept.current().items() if b not in hit} == {b: g for b, g in before.items() if b not in hit}
        every += made(seed, n, sites)
        assert rows(kept.latest()) == rows(latest_n(spark.createDataFrame(every, ARTICLES_DDL), 4))
    assert rows(kept.latest(2)) == rows(latest_n(spark.createDataFrame(every, ARTICLES_DDL), 2))
    with pytest.raises(ValueError):
        kept.latest(5)
    kept.vacuum()
    assert rows(kept.latest()) == rows(latest_n(spark.createDataFrame(every, ARTICLES_DDL), 4))
    documents = lambda a: {r.website: r.xml for r in feeds.build_feeds(a, 3, "rss").collect()}
    assert documents(kept.read()) == documents(spark.createDataFrame(every, ARTICLES_DDL))


def test_a_batch_that_died_is_not_seen(spark, tmp_path):
    kept = LatestArticles(spark, str(tmp_path / "l"), 2, buckets=2)
    kept.update(spark.createDataFrame(made(1, 20), ARTICLES_DDL))
    before = rows(kept.latest())
    # Written, but not named as a generation.
    kept.read().limit(0).withColumn("bucket", F.lit(0)).write.partitionBy("bucket").parquet(f"{kept.path}/tops/gen=2")
    assert rows(kept.latest()) == before
    kept.update(spark.createDataFrame(made(2, 20), ARTICLES_DDL))
    assert rows(kept.latest()) == rows(latest_n(spark.createDataFrame(made(1, 20) + made(2, 20), ARTICLES_DDL), 2))


def test_with_runs(spark, tmp_path):
    sites, articles, kept = sites_table(spark, SITES), ParquetStore(spark, str(tmp_path / "a")), LatestArticles(spark, str(tmp_path / "l"), 1)
    for part in (PAGES[:4], PAGES):
        run_ingest(spark, pages(spark, part), sites, articles, str(tmp_path / "r"), latest=kept)
        assert rows(kept.latest()) == rows(latest_n(articles.read(), 1)) != []


def test_nothing_yet(spark, tmp_path):
    kept = LatestArticles(spark, str(tmp_path / "l"), 3)
    assert kept.latest().collect() == []
    kept.update(spark.createDataFrame([], ARTICLES_DDL))
    assert kept.latest().collect() == [] and kept.current() == {}
    with pytest.raises(ValueError):
        LatestArticles(spark, str(tmp_path / "l"), 0)
