import contextlib
import math
import os
import random
import time
from concurrent.futures import ThreadPoolExecutor

import numpy as np
import pytest

from newsloom.llm import vectors as V
from newsloom.llm.queries import op10_embedding_near_dedup
from newsloom.scratch import scratch_root


def plain(rows, cosine):
    def good(v):
        return v is not None and all(x is not None and math.isfinite(x) for x in v) and any(v)

    close = np.zeros((len(rows), len(rows)), bool)
    for dimension in {len(v) for _, v in rows if good(v)}:
        at = np.array([i for i, (_, v) in enumerate(rows) if good(v) and len(v) == dimension])
        x = np.array([rows[i][1] for i in at], float)
        x /= np.abs(x).max(axis=1, keepdims=True)
        x /= np.sqrt((x * x).sum(axis=1, keepdims=True))
        close[np.ix_(at, at)] = x @ x.T >= cosine
    np.fill_diagonal(close, False)
    out = []
    for i, (d, _) in enumerate(rows):
        stack, seen = [i], {i}
        while stack:
            for j in np.flatnonzero(close[stack.pop()]):
                if j not in seen:
                    seen.add(j)
                    stack.append(j)
        least = min((rows[j][0] for j in seen if rows[j][0] is not None), default=None)
        out.append((d, int(close[i].sum()), least, d == least))
    return out


def made(seed, n=700, dimension=12, hot=150):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, dimension))
    for i in range(0, n - 1, 3):
        x[i + 1] = x[i] + rng.normal(size=dimension) * rng.choice([0, 0.1, 0.3])
    x[:hot] = x[0] + rng.normal(size=(hot, dimension)) * 0.25
    x[hot : hot + 40] = x[hot]
    rows = [(i, [float(np.float32(c)) for c in v]) for i, v in enumerate(x)]
    random.Random(seed).shuffle(rows)
    odd = [None, [], [0.0] * dimension, [1.0] * (dimension - 1), [None] + [1.0] * (dimension - 1)]
    odd += [[float("nan")] + [1.0] * (dimension - 1), [float("inf")] + [1.0] * (dimension - 1)]
    rows += [(9000 + i, v) for i, v in enumerate(odd)]
    # Vectors of a second model, some of them near each other.
    other = rng.normal(size=(60, dimension + 3))
    other[1::2] = other[::2] + 0.05 * rng.normal(size=(30, dimension + 3))
    rows += [(8000 + i, [float(np.float32(c)) for c in v]) for i, v in enumerate(other)]
    scaled = [c * 1024 for c in rows[0][1]]
    return rows + [rows[0], rows[0], (9100, scaled), (None, rows[1][1]), (None, None), (rows[2][0], rows[3][1])]


@pytest.mark.parametrize("seed, element", [(1, "float"), (2, "double")])
def test_against_all_pairs(spark, seed, element, monkeypatch):
    monkeypatch.setattr(V, "INTERVAL_BYTES", 20 * 12 * (4 if element == "float" else 8))
    monkeypatch.setattr(V, "PIECE", 6)
    monkeypatch.setattr(V, "FAN", 4)
    rows = made(seed)
    schema = f"vec_id long, embedding array<{element}>, label int, node string, id int"
    table = spark.createDataFrame([(*r, 0, "", 0) for r in rows], schema)
    got = sorted((tuple(r) for r in V.similar_vectors(table).collect()), key=str)
    assert got == sorted(plain(rows, 0.9), key=str)


def test_distant_boxes_are_skipped(spark, monkeypatch):
    monkeypatch.setattr(V, "INTERVAL_BYTES", 50 * 3 * 8)
    monkeypatch.setattr(V, "FAN", 4)
    rng = np.random.default_rng(5)
    rows = [(i, v.tolist()) for i, v in enumerate(rng.normal(size=(3000, 3)))]
    table = spark.createDataFrame([(i, v, 1, str(i).encode()) for i, v in rows], "id long, vector array<double>, size long, node binary")
    turned = V.principal_dimensions(table.select("node", "vector"), 3)
    cut = V.intervals(table.select("node", "size", "vector"), turned, 0.99)
    boxes = V.numbered(V.materialize(cut, "t").select("part", "place", "box"))
    n = boxes.count()
    pairs = V.near_intervals(boxes, 3, 0.99).collect()
    assert sorted(r.id for r in boxes.collect()) == list(range(n)) and n >= 60
    assert len(pairs) < 0.5 * n * (n + 1) / 2 and {(i, i) for i in range(n)} <= {(r.a, r.b) for r in pairs}


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [0.0]), (2, [1.0]), (2, [2.0])]])
def test_small(spark, rows):
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = sorted(tuple(r) for r in V.similar_vectors(table).collect())
    assert got == sorted(plain(rows, 0.9))


def test_query(spark):
    sf = "/root/testdata/sf0.01"
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    got = sorted(tuple(r) for r in op10_embedding_near_dedup(spark, sf).collect())
    assert got == sorted(plain(rows, 0.9))


def bytes_on_disk(folders):
    found = 0
    for d, _, names in (x for top in folders for x in os.walk(top)):
        for name in names:
            with contextlib.suppress(FileNotFoundError):
                found += os.path.getsize(os.path.join(d, name))
    return found


def test_disk_follows_the_vectors(spark, monkeypatch):
    """Where no boxes are apart, 8,000 pairs of intervals are compared."""
    monkeypatch.setattr(V, "INTERVAL_BYTES", 64 * 64 * 4)
    rng = np.random.default_rng(3)
    x = rng.normal(size=(8000, 64)).astype(np.float32)
    x[1::10] = x[::10] + 0.01
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    table = V.materialize(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), "t")
    blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
    folders = [d.getPath() for d in blocks] + [scratch_root(spark).removeprefix("file:")]
    before = most = bytes_on_disk(folders)
    with ThreadPoolExecutor(1) as other:
        got = other.submit(lambda: V.similar_vectors(table).collect())
        while not got.done():
            most = max(most, bytes_on_disk(folders))
            time.sleep(0.05)
    assert most - before < 5 * x.nbytes
    assert sorted(tuple(r)[:2] for r in got.result()) == [(i, int(i % 10 < 2)) for i in range(8000)]


@pytest.mark.parametrize("seed, strip", [(3, 1), (4, 5)])
def test_strip_after_strip(spark, seed, strip, monkeypatch):
    monkeypatch.setattr(V, "INTERVAL_BYTES", 20 * 12 * 4)
    monkeypatch.setattr(V, "SORTED", 2)
    monkeypatch.setattr(V, "STRIP_BYTES", strip * 40 * 12 * 4)
    monkeypatch.setattr(V, "PIECE", 7)
    monkeypatch.setattr(V, "EXACT_BYTES", 10 * 12 * 8)
    rows = made(seed)
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(7)
    got = sorted((tuple(r) for r in V.similar_vectors(table).collect()), key=str)
    assert got == sorted(plain(rows, 0.9), key=str)


def test_rows_of_one_node_become_one(spark, monkeypatch):
    monkeypatch.setattr(V, "INTERVAL_BYTES", 16 * 3 * 8)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 10)
    try:
        vectors = [[float(i + 1), 1.0, 0.0] for i in range(50)]
        rows = [(i % 50, 1 + i % 3) for i in range(50 * 30)]
        table = spark.createDataFrame([(b"%016d" % i, n, vectors[i]) for i, n in rows], "node binary, size long, vector array<double>")
        cut = V.intervals(table.repartition(5), np.eye(3), 0.9).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    names = [bytes(r.nodes)[k : k + 16] for r in cut for k in range(0, len(r.nodes), 16)]
    sizes = [n for r in cut for n in np.frombuffer(r.sizes, "<i8").tolist()]
    assert dict(zip(names, sizes, strict=True)) == {b"%016d" % i: 60 for i in range(50)} and len(names) == 50


@pytest.mark.parametrize("leading", [1, 5, 16])
def test_keys_bound_the_cosine(leading):
    rng = np.random.default_rng(leading)
    x = V.unit(rng.normal(size=(300, 16)) * np.linspace(2, 0.1, 16))
    key = V.keys(x, leading)
    assert (key @ key.T >= x @ x.T - V.room(leading)).all()


@pytest.mark.parametrize("links", [0, 40, 400, 3000])
def test_forest(links):
    rng = np.random.default_rng(links)
    forest, group = V.Forest(100), list(range(100))
    for some in np.array_split(rng.integers(0, 100, (2, links)), 5, axis=1):
        forest.add(*some)
        for a, b in some.T.tolist():
            a, b = group[a], group[b]
            group = [min(a, b) if g in (a, b) else g for g in group]
    assert forest.roots(np.arange(100)).tolist() == group


def test_copies_and_scale_of_one_vector(spark):
    rng = np.random.default_rng(11)
    hot = rng.normal(size=20)
    rows = [(i, (hot * (1 + i % 2)).tolist()) for i in range(3000)] + [(5000 + i, (hot + 0.02 * rng.normal(size=20)).tolist()) for i in range(1500)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(9)
    got = sorted(tuple(r) for r in V.similar_vectors(table).collect())
    assert got == [(i, len(rows) - 1, 0, i == 0) for i, _ in rows]
