import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from newsloom.llm import lexical as R
from newsloom.llm.queries import op11_ranked_search

DOCS = "doc_id long, text string, item_id int, score double, rank string"
ITEMS = "item_id string, text string, doc_id int, h int"
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def plain(docs, items, top=R.TOP):
    listed = [(i, terms(t)) for i, t, *_ in docs]
    n_docs, n_terms = sum(1 for _, ws in listed if ws), sum(len(ws) for _, ws in listed)
    counted = [(i, len(ws), Counter(ws)) for i, ws in listed]
    held = Counter(w for _, _, c in counted for w in c)
    of = {}
    for i, t, *_ in items:
        of.setdefault(i, set()).update(terms(t))
    out = []
    for item, ws in of.items():
        weight = {w: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * held[w] + 1))) for w in ws if held[w]}
        scored = []
        for i, n, c in counted:
            m = 50 + (50 * n * n_docs) // n_terms if n else 0
            s = sum(v * ((1_000_000_000 * c[w]) // (1000 * c[w] + 20 * m)) for w, v in weight.items() if c[w])
            if s > 0:
                scored.append((-s, i is not None, i or 0))
        out += [(item, r + 1, i if some else None, -s) for r, (s, some, i) in enumerate(sorted(scored)[:top])]
    return sorted(out, key=str)


def made(seed):
    rng = random.Random(seed)
    words = [f"w{k}" for k in range(80)] + ["Été", "漢字", "A1", "a1", "é"]
    text = lambda n: "".join(rng.choice(words) + rng.choice([" ", "\n", "-", "_", "\x00", "@[`{"]) for _ in range(n))
    docs = [(i, text(rng.choice([1, 3, 20, 60])), 0, 0.0, "") for i in range(400)]
    docs += [(1000 + i, docs[5][1], 0, 0.0, "") for i in range(120)]  # ties
    docs += [(2000, None, 0, 0.0, ""), (2001, "", 0, 0.0, ""), (2002, " -- ", 0, 0.0, ""), (2003, text(30_000), 0, 0.0, "")]
    docs += [docs[7], docs[7], (7, "w1 w2 other text", 0, 0.0, ""), (None, docs[5][1], 0, 0.0, "")]
    common = text(6)
    items = [(f"i{k}", text(rng.choice([2, 8, 15])) + (common if k % 2 else ""), 0, 0) for k in range(30)]
    items += [("none", None, 0, 0), ("empty", "", 0, 0), ("unknown", "zzz yyy", 0, 0), (None, "w3 w4", 0, 0), (None, "w5", 0, 0)]
    items += [items[0], ("i1", "w9 w10 w11", 0, 0), ("copy", items[4][1], 0, 0)]
    rng.shuffle(docs)
    return docs, items


@pytest.mark.parametrize("seed, group, held", [(1, 1 << 18, 1 << 19), (2, 60, 3000)])
def test_against_plain(spark, monkeypatch, seed, group, held):
    monkeypatch.setattr(R, "GROUP_TERMS", group)
    monkeypatch.setattr(R, "TEXT_BYTES", held)
    monkeypatch.setattr(R, "ACCUMULATOR_BYTES", held)
    monkeypatch.setattr(R, "POOL", held)
    docs, items = made(seed)
    found = R.ranked_documents(spark.createDataFrame(docs, DOCS).repartition(5), spark.createDataFrame(items, ITEMS))
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    expected = plain(docs, items)
    assert sorted((tuple(r) for r in found.collect()), key=str) == expected and len(expected) > 1000


def expanded(graph):
    """The parts of every item, from the sums of the graph."""
    parts = [[k] for k in range(graph.parts)]
    for left, right in graph.rounds:
        parts += [parts[a] + parts[b] for a, b in zip(left, right)]
    return [sum((parts[k] for k in graph.nodes[a:b]), []) for a, b in zip(graph.first[:-1], graph.first[1:])]


@pytest.mark.parametrize("seed", [0, 1, 2])
def test_graph_holds_every_term_of_an_item_once_and_shares(seed):
    rng = np.random.default_rng(seed)
    shared = [rng.integers(0, 300, 12) for _ in range(8)]
    sets = [set(np.concatenate([shared[rng.integers(8)], shared[rng.integers(8)], rng.integers(0, 300, 5)]).tolist()) for _ in range(60)]
    item = np.repeat(np.arange(60), [len(s) for s in sets])
    hashes = np.concatenate([np.array(sorted(s), np.uint64) for s in sets])
    graph = R.graph_of(pa.array(range(60)), item, hashes)
    of_part = {}
    for h, p in zip(graph.terms.tolist(), graph.part.tolist()):
        of_part.setdefault(p, []).append(h)
    for s, parts in zip(sets, expanded(graph)):
        assert sorted(h for p in parts for h in of_part[p]) == sorted(s)
    assert graph.rounds and graph.additions < 0.7 * (len(hashes) - 60)
    # No pair of neighbours that two items have is left.
    pairs = Counter()
    for a, b in zip(graph.first[:-1], graph.first[1:]):
        pairs.update(zip(graph.nodes[a : b - 1].tolist(), graph.nodes[a + 1 : b].tolist()))
    assert len(expanded(graph)) == 60 and max(pairs.values(), default=0) <= 2


def test_equal_items_are_one_part():
    graph = R.graph_of(pa.array(["a", "b"]), np.array([0, 0, 0, 1, 1, 1]), np.array([5, 6, 7, 5, 6, 7], np.uint64))
    assert graph.parts == 1 and expanded(graph) == [[0], [0]] and graph.additions == 2


def test_sums_of_a_graph():
    rng = np.random.default_rng(3)
    sets = [np.unique(rng.integers(0, 40, 15)) for _ in range(20)]
    item = np.repeat(np.arange(20), [len(s) for s in sets])
    graph = R.graph_of(pa.array(range(20)), item, np.concatenate(sets).astype(np.uint64))
    values = rng.integers(0, 1000, (len(graph.terms), 7))
    term, doc = np.nonzero(values)
    sums = R.accumulators(graph, doc, term, values[term, doc], 7)
    got = np.concatenate([s for _, s in R.item_scores(graph, sums)])
    assert (got == [values[np.searchsorted(graph.terms, s.astype(np.uint64))].sum(axis=0) for s in sets]).all()


def test_empty_tables(spark):
    docs, items = made(4)
    some, none = spark.createDataFrame(docs[:50], DOCS), spark.createDataFrame([], DOCS)
    assert R.ranked_documents(none, spark.createDataFrame(items, ITEMS)).collect() == []
    assert R.ranked_documents(some, spark.createDataFrame([], ITEMS)).collect() == []
    assert R.ranked_documents(spark.createDataFrame([(1, None, 0, 0.0, "")], DOCS), spark.createDataFrame(items, ITEMS)).collect() == []


def test_many_rows_of_one_id(spark):
    docs = spark.range(20_000).selectExpr("7L AS doc_id", "concat('common word', id % 9) AS text").unionByName(
        spark.range(3).selectExpr("CAST(NULL AS LONG) AS doc_id", "'common' AS text"))
    got = R.ranked_documents(docs, spark.createDataFrame([("q", "word3 common", 0, 0)], ITEMS)).collect()
    assert len(got) == 50 and {r.doc_id for r in got} == {7} and len({r.score for r in got}) == 1


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    docs, items = ([tuple(r) for r in spark.read.parquet(f"{sf}/{n}.parquet").select(i, "text").collect()] for n, i in (("documents", "doc_id"), ("benchmark", "item_id")))
    assert sorted((tuple(r) for r in op11_ranked_search(spark, sf).collect()), key=str) == plain(docs, items)
