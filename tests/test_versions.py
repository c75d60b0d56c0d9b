import random

from pyspark.sql import functions as F

from newsloom.operators import frontier
from newsloom.sources import versions as V

RULES = "website string, valid_from int, ignore_all boolean, listed_keys array<string>, restrict string, exclude string, max_visits int"


def versions(spark, rows):
    return spark.createDataFrame([(w, at, None, [], r, x, 0) for w, at, r, x in rows], RULES)


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, website string, url string, arrived int")


def test_the_version_of_the_arrival_holds(spark):
    rng = random.Random(1)
    table = [(f"w{k % 7}", rng.randrange(0, 100, 10), f"/r{k}", None) for k in range(30)]
    table = list({(w, at): (w, at, r, x) for w, at, r, x in table}.values())
    rows = [(i, f"w{rng.randrange(9)}", f"http://x/{i}", rng.choice([None, *range(-5, 110)])) for i in range(400)]
    got = V.with_rules_at(pages(spark, rows), versions(spark, table), "arrived", F.col("page_id"))
    assert {"page_id", "website", "url", "arrived", "valid_from", "restrict"} <= set(got.columns)
    found = {r.page_id: r.restrict for r in got.collect()}
    expected = {}
    for i, w, _, at in rows:
        held = [(f, r) for s, f, r, _ in table if s == w and at is not None and f <= at]
        if held:
            expected[i] = max(held)[1]
    assert found == expected and got.count() == len(expected) > 100


def test_versions_of_one_time(spark):
    got = V.intervals(versions(spark, [("w", 1, "a", None), ("w", 1, "b", None), ("w", 5, "c", None)])).collect()
    assert sorted((r.valid_from, r.valid_to, r.restrict) for r in got) == [(1, 5, "b"), (5, None, "c")]


def test_only_changed_sites_are_decided_again(spark, monkeypatch):
    rows = [(i, f"w{i % 4}", f"http://x/{'news' if i % 3 else 'old'}/{i // 8}", i) for i in range(80)]
    old = [(f"w{k}", 0, None, None) for k in range(4)]
    new = old + [("w1", 40, "/news/", None), ("w2", 20, None, "/old/")]
    decided = V.decide(pages(spark, rows), versions(spark, old), "arrived")
    assert sorted(r.website for r in V.changed_sites(versions(spark, old), versions(spark, new)).collect()) == ["w1", "w2"]
    assert V.changed_sites(versions(spark, new), versions(spark, new)).isEmpty()
    looked = []
    check = frontier.check
    monkeypatch.setattr(frontier, "check", lambda p, **k: looked.append({r.website for r in p.collect()}) or check(p, **k))
    again = V.decide_again(decided, pages(spark, rows), versions(spark, old), versions(spark, new), "arrived")
    assert looked == [{"w1", "w2"}]
    monkeypatch.undo()
    told = lambda d: sorted((r.page_id, r.reason) for r in d.collect())
    assert told(again) == told(V.decide(pages(spark, rows), versions(spark, new), "arrived"))
    assert again.columns == decided.columns and again.filter("reason = 'restrict'").count() > 2 and again.filter("reason = 'exclude'").count() > 2


def test_empty(spark):
    none = pages(spark, [])
    assert V.decide(none, versions(spark, []), "arrived").collect() == []
    assert V.decide(pages(spark, [(1, "w", "http://x/", 3)]), versions(spark, []), "arrived").collect() == []
