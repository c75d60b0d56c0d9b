import hashlib
import random
import re
from collections import Counter

import pytest

from newsloom.llm import decontaminate as D

SCHEMA = "doc_id long, text string, k long, phrase string, start int"
ITEMS = "item_id long, text string, n int"


def words(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def plain(docs, items):
    windows = {}
    for i, t, *_ in items:
        ws = words(t)
        for at in range(max(1, len(ws) - 9) if ws else 0):
            windows.setdefault(tuple(ws[at : at + 10]), set()).add(i)
    out = []
    for d, t, *_ in docs:
        ws, hit, found = words(t), set(), set()
        for n in {len(w) for w in windows}:
            for at in range(len(ws) - n + 1):
                ids = windows.get(tuple(ws[at : at + n]))
                if ids is not None:
                    hit.update(range(at, at + n))
                    found |= {str(i) for i in ids if i is not None}
        ids = sorted(found)
        out.append((d, len(ws), len(hit), len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest(), bool(hit)))
    return out


def made(seed):
    rng = random.Random(seed)
    vocabulary = ["the", "of", "The", "a1", "é", "漢", "x-y", "don't"] + [f"w{i}" for i in range(30)]
    text = lambda n: " ".join(rng.choices(vocabulary, weights=[20] * 4 + [1] * 34, k=n))
    items = [(i, text(rng.choice([0, 1, 3, 9, 10, 11, 30])), 0) for i in range(25)]
    items += [(100, "the the the the the the the the the the the", 0), (101, None, 0), (102, "", 0), (None, "only here once", 0)]
    items += [items[4], (4, "another text of item four is here now and long", 0), (103, "solo", 0)]
    docs = []
    for d in range(120):
        parts = [text(rng.randrange(20))]
        if d % 3 == 0:
            parts.append(rng.choice(items)[1] or "")
        if d % 5 == 0:
            parts.append("!! THE the The, the; the\nthe the the the the the the " * rng.randrange(3))
        docs.append((d, " ".join([*parts, text(rng.randrange(20))]), 0, "", 0))
    docs += [(500, None, 0, "", 0), (501, "", 0, "", 0), (502, "the of " * 40_000 + "solo", 0, "", 0), docs[3], docs[3]]
    docs += [(3, "a different text under the same id: only here once", 0, "", 0), (None, "only here once", 0, "", 0)]
    return docs, items


@pytest.mark.parametrize("seed", [1, 2])
def test_against_plain_search(spark, seed, monkeypatch):
    if seed == 2:
        monkeypatch.setattr(D, "BROADCAST_TERMS", 0)
    docs, items = made(seed)
    tables = spark.createDataFrame(docs, SCHEMA), spark.createDataFrame(items, ITEMS)
    got = D.contamination(*tables).collect()
    expected = plain(docs, items)
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, expected))
    assert any(e[5] for e in expected) and not all(e[5] for e in expected)
    kept = D.remove_contaminated(*tables)
    assert kept.columns == tables[0].columns
    clean = [(d[0], d[1]) for d, e in zip(docs, expected) if not e[5]]
    assert sorted(map(str, ((r.doc_id, r.text) for r in kept.collect()))) == sorted(map(str, clean))


def test_proximity(spark):
    items = spark.createDataFrame([(1, "alpha beta gamma delta", 0)], ITEMS)
    texts = ["alpha beta gamma delta", "alpha x beta gamma y delta", "alpha beta x x x gamma delta", "delta gamma beta alpha", "alpha beta"]
    docs = spark.createDataFrame([(i, t, 0, "", 0) for i, t in enumerate(texts)], SCHEMA)
    near = lambda slop: sorted(r.doc_id for r in D.proximity_matches(docs, items, slop).collect())
    assert near(0) == [0] and near(1) == [0, 1] and near(3) == [0, 1, 2] and near(4) == [0, 1, 2, 3]


def test_proximity_looks_for_every_word(spark):
    rng = random.Random(5)
    ws = [f"w{k}" for k in range(14)]
    item = " ".join(ws[:8])
    made_ = []
    for _ in range(120):
        text = ws[:8]
        for _ in range(rng.choice([0, 1, 2, 3])):
            at = rng.randrange(8)
            text = [*text[:at], rng.choice(ws), *text[at:]] if rng.random() < 0.6 else [*text[:at], *text[at + 1 :]]
        made_.append(" ".join([*rng.choices(ws, k=rng.randrange(4)), *text]))
    docs = spark.createDataFrame([(i, t, 0, "", 0) for i, t in enumerate([*made_, None, ""])], SCHEMA)
    counts = Counter(w for t in made_ for w in t.split())
    rarest = min(range(8), key=lambda i: (counts[ws[i]], i))
    for slop in (0, 1, 2):
        expected = set()
        for i, t in enumerate(made_):
            text = t.split()
            for start in (at - rarest for at, w in enumerate(text) if w == ws[rarest]):
                if all(ws[k] in text[max(0, start + k - slop) : max(0, start + k + slop + 1)] for k in range(8)):
                    expected.add(i)
        got = D.proximity_matches(docs, spark.createDataFrame([(1, item, 0), (2, None, 0)], ITEMS), slop).collect()
        assert {r.doc_id for r in got} == expected and len(got) == len(expected) and 0 < len(expected) < 120


@pytest.mark.parametrize("docs, items", [([], [(1, "a b", 0)]), ([(1, "a b", 0, "", 0)], []), ([], [])])
def test_empty(spark, docs, items):
    got = D.contamination(spark.createDataFrame(docs, SCHEMA), spark.createDataFrame(items, ITEMS)).collect()
    assert [tuple(r) for r in got] == plain(docs, items)


def test_no_python_on_the_main_path(spark, capfd):
    docs, items = made(1)
    D.contamination(spark.createDataFrame(docs, SCHEMA), spark.createDataFrame(items, ITEMS)).explain()
    assert not re.search("Python|Arrow|Pandas", capfd.readouterr().out)
