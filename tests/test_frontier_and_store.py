import hashlib

import pytest
from pyspark.sql import functions as F

from newsloom.operators import frontier, store
from newsloom.plans import samples
from newsloom.plans.samples import with_rules
from newsloom.sources.articles import ARTICLES_DDL, ParquetStore


def skewed_urls(spark, n=4000):
    """A third of all rows on one site, another third copies of one URL."""
    i = F.col("id")
    website = F.when(i % 3 < 2, F.lit("hot")).otherwise(F.concat(F.lit("s"), (i % 40).cast("string")))
    path = F.when(i % 3 == 0, F.lit("same")).otherwise((i % 997).cast("string"))
    return spark.range(n).select(
        i.alias("page_id"), website.alias("website"),
        F.concat(F.lit("http://"), website, F.lit("/"), path, F.lit("?x="), i.cast("string")).alias("url"),
    )


def test_decisions_against_brute_force(spark):
    pages = with_rules(skewed_urls(spark), ignore_all=True, restrict="http://(hot|s1)", exclude="/1.*2$")
    stored = spark.createDataFrame([("hot", "http://hot/same"), ("s1", "http://s1/4")], "website string, url string")
    got = {(r.page_id): r.reason for r in frontier.decide(frontier.check(pages), stored).collect()}
    known, seen, wanted = {tuple(r) for r in stored.collect()}, set(), {}
    import re
    for r in sorted(pages.collect(), key=lambda r: r.page_id):
        url = r.url.split("?")[0]
        if not re.search("http://(hot|s1)", url):
            wanted[r.page_id] = "restrict"
        elif re.search("/1.*2$", url):
            wanted[r.page_id] = "exclude"
        elif (r.website, url) in seen:
            wanted[r.page_id] = "seen"
        else:
            seen.add((r.website, url))
            wanted[r.page_id] = "stored" if (r.website, url) in known else None
    assert got == wanted


@pytest.mark.parametrize("budget", [1, 7, 500, 100_000, 0])
def test_budget_against_brute_force(spark, budget):
    rows = with_rules(skewed_urls(spark), ignore_all=True, max_visits=budget)
    rows = rows.withColumn("depth", F.col("page_id") % 4)
    got = {r.page_id for r in frontier.within_budget(rows, url="url", depth="depth").collect()}
    by_site = {}
    for r in rows.collect():
        by_site.setdefault(r.website, []).append(
            (r.depth, hashlib.md5(r.url.encode()).hexdigest(), r.url, r.page_id)
        )
    wanted = {row[-1] for site in by_site.values() for row in sorted(site)[: budget or None]}
    assert got == wanted


def test_budget_rejects_are_kept(spark):
    pages = with_rules(skewed_urls(spark), ignore_all=True, max_visits=5)
    decided = frontier.decide(frontier.check(pages))
    judged = frontier.apply_budget(decided)
    counts = {r.reason: r["count"] for r in judged.groupBy("reason").count().collect()}
    assert judged.count() == 4000 and counts["budget"] > 0
    per_site = judged.filter("accepted").groupBy("website").count().collect()
    assert max(r["count"] for r in per_site) == 5


def article(website, url, title="t", content="c", date="2024-01-01", **rest):
    return {"website": website, "url": url, "title": title, "description": rest.get("description"),
            "content": content, "author": rest.get("author"), "date": date}


def frame(spark, rows):
    ddl = ARTICLES_DDL.replace("date date", "date string")
    names = [c.split()[0] for c in ddl.split(", ")]
    made = spark.createDataFrame([tuple(r[n] for n in names) for r in rows], ddl)
    return made.withColumn("date", F.col("date").cast("date")).withColumn("seq", F.monotonically_increasing_id())


def test_first_write_wins_across_websites_and_replays(spark, tmp_path):
    articles = ParquetStore(spark, str(tmp_path / "a"))
    assert articles.read().count() == 0
    batch = frame(spark, [
        article("a", "http://x/1", description=""), article("b", "http://x/1"),
        article("a", "http://x/2", title=None), article("a", "http://x/2"),
        article("a", None), article("007", "http://x/3", date=None),
        article("007", "http://x/4", author="n"),
    ])
    judged = store.first_write_wins(batch, articles.read())
    rows = {(r.website, r.url, r.title): r.reason for r in judged.collect()}
    assert rows == {
        ("a", "http://x/1", "t"): None, ("b", "http://x/1", "t"): "duplicate_url",
        ("a", "http://x/2", None): "null_title", ("a", "http://x/2", "t"): None,
        ("a", None, "t"): "null_url", ("007", "http://x/3", "t"): "null_date",
        ("007", "http://x/4", "t"): None,
    }
    articles.append(judged.filter("reason IS NULL"))
    stored = {(r.website, r.url): (r.description, r.author) for r in articles.read().collect()}
    # an empty text stays empty, a null stays null, a numeric-looking website stays text
    assert stored == {("a", "http://x/1"): ("", None), ("a", "http://x/2"): (None, None),
                      ("007", "http://x/4"): (None, "n")}
    again = store.first_write_wins(batch, articles.read())
    assert again.filter("reason IS NULL").count() == 0
    assert [r.url for r in store.stored_urls(articles.read(), "007").collect()] == ["http://x/4"]
    assert {tuple(r) for r in store.stored_counts(articles.read()).collect()} == {("a", 2), ("007", 1)}


def test_one_url_in_a_third_of_a_batch(spark):
    i = F.col("id")
    batch = spark.range(3000).select(
        i.alias("seq"), F.lit("w").alias("website"),
        F.when(i % 3 == 1, F.lit("http://hot/")).otherwise(F.concat(F.lit("http://x/"), i.cast("string"))).alias("url"),
        F.lit("t").alias("title"), F.lit("c").alias("content"), F.lit("2024-01-01").cast("date").alias("date"),
    )
    verdicts = store.write_verdicts(batch, None)
    written = [r.seq for r in verdicts.filter("reason IS NULL").collect()]
    assert len(written) == 2001 and [s for s in written if s % 3 == 1] == [1]


def test_urls_are_combined_before_any_join(spark):
    batch = frame(spark, [article("a", "http://x/1")])
    stored = spark.createDataFrame([("http://x/2",)], "url string")
    plan = store.first_claims(batch, stored, "seq")._jdf.queryExecution().optimizedPlan().toString()
    lines = plan.splitlines()
    joins = [i for i, line in enumerate(lines) if "Join LeftOuter" in line]
    combined = [i for i, line in enumerate(lines) if "Aggregate [url" in line and "min(seq" in line]
    assert len(joins) == 1 and combined and joins[0] < combined[0] and "LeftAnti" not in plan


def test_website_reads_are_pruned(spark, tmp_path):
    articles = ParquetStore(spark, str(tmp_path / "a"))
    articles.append(frame(spark, [article("a", "http://x/1"), article("b", "http://x/2")]))
    plan = store.stored_urls(articles.read(), "a")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(website" in plan and "ReadSchema: struct<url:string>" in plan


def test_latest_n_against_brute_force(spark):
    i = F.col("id")
    rows = spark.range(3000).repartition(16).select(
        F.when(i % 3 > 0, F.lit("hot")).otherwise(F.concat(F.lit("s"), (i % 50).cast("string"))).alias("website"),
        F.concat(F.lit("http://x/"), i.cast("string")).alias("url"),
        F.date_add(F.lit("2024-01-01").cast("date"), (i % 17).cast("int")).alias("date"),
        F.lit("t").alias("title"), F.lit("c").alias("content"),
    )
    got = sorted((r.website, r.rn, r.url) for r in store.latest_n(rows, 7).collect())
    by_site = {}
    for r in rows.collect():
        by_site.setdefault(r.website, []).append((-r.date.toordinal(), r.url))
    wanted = sorted((w, n, u) for w, site in by_site.items() for n, (_, u) in enumerate(sorted(site)[:7], 1))
    assert got == wanted
    one = [r.url for r in store.latest_for(rows, "hot", 7).collect()]
    assert one == [u for w, _, u in wanted if w == "hot"]
    plan = store.latest_urls(rows, 7)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") >= 2 and "AS content" not in plan
    with pytest.raises(ValueError):
        store.latest_n(rows, 0)


def test_stored_urls_meet_rows_under_the_salts_that_these_have(spark):
    rows = spark.createDataFrame([(i, "w", f"u{i % 300 if i < 600 else 7}") for i in range(1_000)], "page_id long, website string, canonical_url string")
    stored = spark.createDataFrame([("w", f"u{i}") for i in range(0, 400, 7)], "website string, url string")
    found = frontier.unseen_rows(rows, ["website", "canonical_url"], stored)
    assert {r.page_id for r in found.collect()} == {i for i in range(600) if i % 300 % 7}
    # Only salts that occur: none are made up for each stored URL.
    assert "Generate" not in found._jdf.queryExecution().analyzed().toString()


def test_pages_of_runs_are_not_shuffled_before_the_run_spreads_them(spark, tmp_path):
    docs = [(i, f"Title {i}\nbody", ("en", "es", "de", None)[i % 4], f"src{i % 3}", 10 + i) for i in range(40)] + [(None, "x", "es", "src1", 1)]
    docs = spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long")
    docs.coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    pages = samples.doc_pages_with_copies(spark, str(tmp_path))
    assert "REPARTITION_BY" not in pages._jdf.queryExecution().executedPlan().toString()
    spread = [tuple(r) for r in samples.doc_pages(spark, str(tmp_path)).collect()]
    copies = [(i + (1 << 40), w, f"{u}?copy=1#top", h) for i, w, u, h in spread if i is not None and i % 4 == 1]
    assert sorted(map(str, pages.collect())) == sorted(map(str, pages.sparkSession.createDataFrame(spread + copies, pages.schema).collect()))


def test_document_pages_are_dealt_to_tasks_by_their_number(spark, tmp_path):
    docs = spark.range(30).selectExpr("id AS doc_id", "'en' AS lang", "'site1' AS source", "'a text' AS text", "6L AS n_chars")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    dealt = samples.doc_pages(spark, str(tmp_path))
    assert dealt.rdd.getNumPartitions() == 2
    assert dealt.count() == 30
