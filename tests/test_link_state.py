import random
import re

import pytest

from newsloom.functions import urls
from newsloom.operators import links
from newsloom.operators.link_state import LinkState, bucket_of
from newsloom.plans.ingest import run_ingest
from newsloom.sources.articles import IndexedStore, ParquetStore
from newsloom.sources.config import Site, sites_table
from newsloom.streaming.ingest_stream import ingest_landing
from test_ingest import PAGES, SITES, page, pages, rejected, stored

FREE = [Site(s.website, s.start_point, s.selectors, s.date_format, ignore_all=s.ignore_all, restrict=s.restrict, exclude=s.exclude) for s in SITES]


def whole(spark, tmp_path, rows):
    articles = ParquetStore(spark, str(tmp_path / "whole"))
    run_ingest(spark, pages(spark, rows), sites_table(spark, FREE), articles, str(tmp_path / "wr"), follow_links=True)
    return stored(articles)


def test_pages_that_land_before_their_links(spark, tmp_path):
    sites, articles, state = sites_table(spark, FREE), IndexedStore(spark, str(tmp_path / "a")), LinkState(spark, str(tmp_path / "s"), 4)
    order = [r for r in PAGES if r[0] not in (1, 8)]
    got = []
    for rows in (order[6:], order[:6], [PAGES[7]], [PAGES[0]]):
        run = run_ingest(spark, pages(spark, rows), sites, articles, str(tmp_path / "r"), follow_links=True, link_state=state)
        got.append(len(stored(articles)))
    assert stored(articles) == whole(spark, tmp_path, PAGES) and got[:2] == [0, 0] and got[2] > 0
    # The last run says what became of the pages that it reached, whenever they landed.
    assert ("acme", "http://acme.tld/news/3", "bad_date") in rejected(run)
    again = run_ingest(spark, pages(spark), sites, articles, str(tmp_path / "r"), follow_links=True, link_state=state)
    assert again.decisions.filter("accepted").isEmpty() and again.visited.isEmpty()
    assert again.decisions.filter("reason = 'seen'").count() > 5


def graph(seed):
    """Pages of which every one links to two further ones and somewhere else, in any order."""
    rng = random.Random(seed)
    linked = lambda i: [2 * i + 1, 2 * i + 2] if i % 5 != 4 else []
    rows = [(i, f"http://zeta.tld/{i or 'start'}", page(f"t{i}", *[f"/{k}" for k in [*linked(i), rng.randrange(1, 40)]])) for i in range(30)]
    rng.shuffle(rows)
    return rows


def test_any_order_of_batches(spark, tmp_path):
    rows = graph(1)
    sites, articles, state = sites_table(spark, FREE[1:]), ParquetStore(spark, str(tmp_path / "a")), LinkState(spark, str(tmp_path / "s"), 4)
    # Every batch numbers its pages from 0, and repeats some pages of the one before.
    for at in range(0, len(rows), 10):
        batch = [(k, *r[1:]) for k, r in enumerate(rows[max(0, at - 3) : at + 10])]
        run_ingest(spark, pages(spark, batch), sites, articles, str(tmp_path / "r"), follow_links=True, link_state=state)
    edges = {int(r[1].rsplit("/", 1)[1].replace("start", "0")): [int(x) for x in re.findall(r'href="/(\d+)"', r[2])] for r in rows}
    reached, level = {0}, [0]
    while level:
        level = [b for a in level for b in edges.get(a, []) if b < 30 and b not in reached]
        reached |= set(level)
    assert {v for v in stored(articles).values()} == {f"t{i}" for i in reached} and 10 < len(reached) < 30


def test_a_run_opens_the_edges_of_newly_reached_pages_only(spark, tmp_path, monkeypatch):
    state = LinkState(spark, str(tmp_path / "s"), 16)
    row = lambda *names: spark.createDataFrame([("w", n) for n in names], "website string, url string")
    edges = lambda *pairs: spark.createDataFrame([("w", a, b) for a, b in pairs], "website string, from_url string, to_url string")
    start = row("s")
    many = [f"x{i}" for i in range(200)]
    assert state.advance(1, row(*many, "c"), edges(*[(a, "c") for a in many], ("c", "d")), start).isEmpty()
    assert sorted(r.url for r in state.advance(2, row("s", "d"), edges(("s", "q"), ("s", "s")), start).collect()) == ["s"]
    opened = []
    read = state._read
    monkeypatch.setattr(state, "_read", lambda table, schema, folders: opened.extend(folders) or read(table, schema, folders))
    got = state.advance(3, row("q"), edges(("q", "c")), start)
    assert {r.url: r.landed for r in got.collect()} == {"q": 3, "c": 1, "d": 2}
    of_edges = {f for f in opened if "/edges/" in f}
    bucket = lambda u: row(u).select(bucket_of("url", 16)).first()[0]
    part = lambda run, u: f"{state.path}/edges/run={run}/bucket={bucket(u)}"
    assert {part(3, "q"), part(1, "c")} <= of_edges <= {part(3, "q"), part(1, "c"), part(2, "d")}
    assert all(re.search(r"bucket=", f) for f in opened)
    # Repeated, the run gives the same and changes nothing.
    assert {r.url for r in state.advance(3, row("q"), edges(("q", "c")), start).collect()} == {"q", "c", "d"}


def test_runs_have_numbers(spark, tmp_path):
    state = LinkState(spark, str(tmp_path / "s"))
    assert [state.number(x) for x in ("a-1", "b-2", "a-1", "c")] == [1, 2, 1, 3]


def test_refused_with_budgets(spark, tmp_path):
    state = LinkState(spark, str(tmp_path / "s"))
    for sites, follow in ((SITES, True), (FREE, False)):
        with pytest.raises(ValueError):
            run_ingest(spark, pages(spark), sites_table(spark, sites), ParquetStore(spark, str(tmp_path / "a")), str(tmp_path / "r"), follow_links=follow, link_state=state)


def test_in_a_stream_and_replayed(spark, tmp_path, monkeypatch):
    sites, articles, state = sites_table(spark, FREE), ParquetStore(spark, str(tmp_path / "a")), LinkState(spark, str(tmp_path / "s"), 4)
    landing = str(tmp_path / "in")
    call = lambda: ingest_landing(spark, landing, sites, articles, str(tmp_path / "r"), str(tmp_path / "c"), "n", follow_links=True, link_state=state)
    once = [r for r in PAGES if r[0] != 4]  # of two pages of one URL the first to land counts
    for rows in (once[3:], once[1:3], once[:1]):
        pages(spark, rows).coalesce(1).write.mode("append").parquet(landing)
        if len(rows) == 2:
            with monkeypatch.context() as m:
                m.setattr(ParquetStore, "append", lambda self, a: (_ for _ in ()).throw(RuntimeError("lost")))
                with pytest.raises(Exception):
                    call()
        call()
    assert stored(articles) == whole(spark, tmp_path, once)
    assert len(articles.read().collect()) == len(stored(articles))


def test_a_round_asks_once_for_the_buckets_of_its_targets(spark, tmp_path, monkeypatch):
    state = LinkState(spark, str(tmp_path / "s"), 4)
    row = lambda *names: spark.createDataFrame([("w", n) for n in names], "website string, url string")
    edges = spark.createDataFrame([("w", "s", "a"), ("w", "a", "b")], "website string, from_url string, to_url string")
    asked, buckets = [], state._buckets
    monkeypatch.setattr(state, "_buckets", lambda rows: asked.append(1) or buckets(rows))
    assert sorted(r.url for r in state.advance(1, row("s", "a", "b"), edges, row("s")).collect()) == ["a", "b", "s"]
    # three rounds, and the pages that landed
    assert len(asked) == 4


def test_a_link_is_resolved_once(spark):
    """Filters on the target repeat neither its resolution nor what it is made from."""
    read = spark.range(2).selectExpr(
        "'a' AS website", "concat('https://a.tld/x/', id) AS url", "array('/1#b', '../c', 'mailto:d', '%zz', null) AS links"
    )
    found = links.harvest(read)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count(urls.PLAIN_ABSOLUTE) == 1
    assert sorted(r.to_url for r in found.collect()) == ["https://a.tld/1"] * 2 + ["https://a.tld/c"] * 2
