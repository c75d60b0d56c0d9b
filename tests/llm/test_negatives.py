import math
import random

import numpy as np
import pytest

from newsloom.llm import negatives as H
from newsloom.llm.queries import op13_hard_negatives

SCHEMA = "vec_id long, embedding array<float>, label int, anchor int, score double, rank string"


def plain(rows, every=100):
    usable = []
    for k, (i, v, label, *_) in enumerate(rows):
        if i is None or label is None or v is None or any(x is None or not math.isfinite(x) or abs(x) > 3000 for x in v):
            continue
        usable.append((i, k, label, [math.floor(256 * float(np.float32(x))) for x in v]))
    out = []
    for i, k, label, v in usable:
        if i % every:
            continue
        scored = [(-sum(a * b for a, b in zip(v, w)), j, kk, ll) for j, kk, ll, w in usable if kk != k and len(w) == len(v)]
        scored.sort()
        for p, j, _, _ in [s for s in scored if s[3] == label][:5]:
            inside = [s for s in scored if s[3] != label and 80 * -p <= 100 * -s[0] <= 100 * -p]
            out += [(i, j, r + 1, s[1], -p, -s[0]) for r, s in enumerate(inside[:5])]
    return sorted(out)


def made(seed, n=900, d=16):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, d))
    rows = []
    for i in range(n):
        v = centres[rng.integers(12)] + 0.15 * rng.normal(size=d)
        rows.append((i * 5, [float(x) for x in v / np.linalg.norm(v)], int(rng.integers(4)), 1, 0.5, "x"))
    rows += [(20_000 + k, rows[0][1], k % 3, 0, 0.0, "") for k in range(30)]  # equal vectors: ties
    rows += [(30_000, None, 1, 0, 0.0, ""), (30_100, rows[3][1], None, 0, 0.0, ""), (None, rows[3][1], 1, 0, 0.0, "")]
    rows += [(30_200, [None] + rows[3][1][1:], 1, 0, 0.0, ""), (30_300, [float("nan")] * d, 1, 0, 0.0, ""), (30_400, [float("inf")] * d, 1, 0, 0.0, "")]
    rows += [(30_500, [0.0] * d, 1, 0, 0.0, ""), (30_600, [1e30] * d, 1, 0, 0.0, ""), (30_700, [], 1, 0, 0.0, ""), (30_701, [], 1, 0, 0.0, ""), (30_702, [], 2, 0, 0.0, "")]
    rows += [(31_000 + k, [float(x) for x in rng.normal(size=3)], k % 2, 0, 0.0, "") for k in range(0, 300, 20)]
    rows += [rows[0], rows[20], rows[20]]  # repeated rows
    random.Random(seed).shuffle(rows)
    return rows


@pytest.mark.parametrize("seed, block_bytes, group_anchors", [(1, 2 << 20, 2048), (2, 64 * 8 * 16, 7)])
def test_against_all_pairs(spark, monkeypatch, seed, block_bytes, group_anchors):
    monkeypatch.setattr(H, "BLOCK_BYTES", block_bytes)
    monkeypatch.setattr(H, "GROUP_ANCHORS", group_anchors)
    rows = made(seed)
    got = H.hard_negatives(spark.createDataFrame(rows, SCHEMA))
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    expected = plain(rows)
    assert sorted(tuple(r) for r in got.collect()) == expected and len(expected) > 200


def test_spanning_tree():
    rng = np.random.default_rng(4)
    x = np.floor(rng.normal(size=(60, 5)) * 100)
    order, parent, edge = H.spanning_tree(x)
    assert sorted(order) == list(range(60)) and parent[0] == -1 and (parent[1:] < np.arange(1, 60)).all() and (parent[1:] >= 0).all()
    whole = np.linalg.norm(x[:, None] - x[None], axis=2)
    assert np.allclose(edge[1:], whole[order[1:], order[parent[1:]]])
    # Kruskal over all pairs weighs the same.
    root = list(range(60))

    def find(v):
        while root[v] != v:
            v = root[v]
        return v

    total = 0.0
    for a, b in sorted(((a, b) for a in range(60) for b in range(a)), key=lambda p: whole[p]):
        if find(a) != find(b):
            root[find(a)] = find(b)
            total += whole[a, b]
    assert edge.sum() == pytest.approx(total)
    for n in (0, 1, 2):
        assert len(H.spanning_tree(x[:n])[0]) == n


def test_bounds_hold_and_spare_scores():
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(30, 24))
    centres *= 256 / np.linalg.norm(centres, axis=1, keepdims=True)
    x = np.floor(centres[rng.integers(30, size=3000)] + 3 * rng.normal(size=(3000, 24)))
    block = H.Block(0, np.arange(3000), np.zeros(3000, np.int64), x, np.sqrt((x * x).sum(axis=1)))
    chosen = x[:200]
    order, parent, edge = H.spanning_tree(chosen)
    last = np.full(200, -1)
    for child, p in enumerate(parent):
        if p >= 0:
            last[p] = child
    blank = np.zeros(200, np.int64)
    walk = H.Walk(H.Anchors(blank, blank, blank, blank, chosen[order], parent, edge, last), block)
    for a in range(200):
        low, high = walk.bounds(a)
        scores = x @ chosen[order[a]]
        assert (low <= scores).all() and (scores <= high).all()
        top = np.sort(scores)[-5]
        rows, found = walk.exact(a, low, high, (high >= 0.8 * top) & (low <= top))
        assert (found == scores[rows]).all()
        assert set(np.flatnonzero((scores >= 0.8 * top) & (scores <= top))) <= set(rows)
    assert walk.scored < 0.5 * 200 * 3000 and len(walk.held) == 0


def test_empty_and_alone(spark):
    assert H.hard_negatives(spark.createDataFrame([], SCHEMA)).collect() == []
    one = spark.createDataFrame([(100, [1.0, 2.0], 1, 0, 0.0, "")], SCHEMA)
    assert H.hard_negatives(one).collect() == []


def test_many_rows_of_one_id_and_vector(spark):
    rows = spark.range(20_000).selectExpr("100L AS vec_id", "array(1.0f, 0.5f) AS embedding", "CAST(id % 2 AS INT) AS label").filter("label = 0")
    rows = rows.limit(300).unionByName(spark.range(20_000).selectExpr("7L AS vec_id", "array(1.0f, 0.5f) AS embedding", "1 AS label"))
    got = H.hard_negatives(rows).collect()
    assert len(got) == 300 * 5 * 5 and {r.negative_id for r in got} == {7} and {r.negative_score for r in got} == {256 * 256 + 128 * 128}


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    rows = [(i, v, (label + 1) % 10 if i % 7 == 0 else label) for i, v, label in rows]
    assert sorted(tuple(r) for r in op13_hard_negatives(spark, sf).collect()) == plain(rows)
