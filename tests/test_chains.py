import random

import pytest
from pyspark.sql import functions as F

from newsloom.operators import links
from newsloom.plans import catalog, samples

SITES = "website string, start_point string, ignore_all boolean, listed_keys array<string>, max_visits int"


def walk(spark, edges, names, start="http://x/0", **options):
    url = lambda n: f"http://x/{n}"
    sites = spark.createDataFrame([("w", start, None, [], 0)], SITES)
    table = spark.createDataFrame([("w", url(a), url(b)) for a, b in edges], "website string, from_url string, to_url string")
    pages = spark.createDataFrame([("w", url(n)) for n in names], "website string, url string")
    return links.reachable_by_contraction(table, sites, pages, **options)


def plain(edges, names, start=0):
    depth, level = {start: 0} if start in names else {}, [start] if start in names else []
    while level:
        following = []
        for a in level:
            for x, b in edges:
                if x == a and b in names and b not in depth:
                    depth[b] = depth[a] + 1
                    following.append(b)
        level = following
    return depth


def depths(found):
    return {int(r.url.rsplit("/", 1)[1]): r.depth for r in found.pages.collect()}


@pytest.mark.parametrize("seed", range(3))
def test_against_breadth_first(spark, seed):
    rng = random.Random(seed)
    n = 60
    edges = [(i, i + 1) for i in range(n) if rng.random() < 0.9]
    edges += [(rng.randrange(n), rng.randrange(n)) for _ in range(rng.choice([4, 15, 60]))]
    edges += [(n + 1, n + 2), (n + 2, n + 3), (n + 3, n + 1), (n + 2, n + 4), (n + 5, n + 5), (7, 7), (3, 0)]
    names = set(range(n + 6)) - {rng.randrange(1, n)}
    found = walk(spark, edges, names)
    assert depths(found) == plain(edges, names) and found.pages.count() == len(depths(found))


def test_shapes(spark):
    assert depths(walk(spark, [(0, 0)], {0})) == {0: 0}
    assert depths(walk(spark, [(1, 2)], {1, 2})) == {}
    # A tree is no more than what hangs on the start; a circle that nothing leads into is not reached.
    tree = [(i, c) for i in range(40) for c in (2 * i + 1, 2 * i + 2)]
    found = walk(spark, tree + [(100, 101), (101, 100), (101, 102)], set(range(81)) | {100, 101, 102})
    assert depths(found) == plain(tree, set(range(81))) and found.rounds <= 6
    # The shorter way wins, whichever is found first.
    edges = [(0, 1), (1, 2), (2, 3), (3, 9), (0, 5), (5, 9), (9, 10), (10, 11), (11, 9)]
    assert depths(walk(spark, edges, set(range(12)))) == plain(edges, set(range(12)))


def test_pages_taken_out_by_coins(spark):
    # A chain of 300 with a leap into it, a bush on its end, a circle that it leads into, and one that it doesn't.
    edges = [(i, i + 1) for i in range(299)] + [(0, 100), (299, 120)] + [(299, c) for c in range(400, 440)]
    edges += [(500 + i, 500 + (i + 1) % 40) for i in range(40)] + [(510, 600), (600, 601)]
    names = set(range(300)) | set(range(400, 440)) | set(range(500, 540)) | {600, 601}
    found = walk(spark, edges, names, few=10)
    assert depths(found) == plain(edges, names) and found.pages.count() == len(depths(found))


def test_rows_of_all_rounds_grow_like_the_pages(spark, monkeypatch):
    written, keep = [], links.materialize
    def counted(df, label):
        made = keep(df, label)
        written.append(made.count() if label in ("pointers", "split") else 0)
        return made
    monkeypatch.setattr(links, "materialize", counted)
    n = 4_000
    at = spark.range(1, n + 1).selectExpr("id", "id - 1 AS above", "1L AS steps", "id = 1 AS ended")
    ends, _ = links._to_ends(at, few=50)
    assert ends.filter("ended AND above = 0 AND steps = id").count() == n == ends.count()
    assert sum(written) < 15 * n  # jumping alone writes all of them in each of 13 rounds, and joins them twice
    assert max(written) <= n


def test_rounds_of_a_long_archive(spark):
    sf = "/root/testdata/sf0.001"
    sites, edges, pages = samples.doc_archives(spark, sf, 410)
    found = links.reachable_by_contraction(edges, sites, pages)
    deepest = found.pages.agg(F.max("depth")).first()[0]
    assert deepest >= 4096 and found.rounds <= 30
    assert "crawl_long_chain" in catalog.SQL
