import random
import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

from newsloom.llm import jaccard as J
from newsloom.llm.queries import op3_jaccard_join

SCHEMA = "doc_id long, text string, node string, class_id int, size int"


def words(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return tuple(re.findall(r"[^\x20\x09-\x0D]+", lowered))


def grams(ws):
    return {ws[i : i + 5] for i in range(len(ws) - 4)} if len(ws) >= 5 else ({ws} if ws else set())


def plain(rows, threshold=0.8):
    texts = [words(r[1]) for r in rows]
    sets = [grams(t) for t in texts]
    n = len(rows)
    similar = lambda i, j: texts[i] == texts[j] or (
        sets[i] and sets[j] and len(sets[i] & sets[j]) >= threshold * len(sets[i] | sets[j]) - 1e-9
    )
    neighbours = [[j for j in range(n) if j != i and similar(i, j)] for i in range(n)]
    group = list(range(n))
    for i in range(n):
        stack, seen = [i], {i}
        while stack:
            for j in neighbours[stack.pop()]:
                if j not in seen:
                    seen.add(j)
                    stack.append(j)
        group[i] = frozenset(seen)
    least = lambda ids: min((i for i in ids if i is not None), default=None)
    return [
        (rows[i][0], least(rows[j][0] for j in range(n) if texts[j] == texts[i]), len(neighbours[i]), least(rows[j][0] for j in group[i]))
        for i in range(n)
    ]


def made(seed):
    rng = random.Random(seed)
    fresh = lambda n: [f"w{rng.randrange(3000)}" for _ in range(n)]
    rows = []
    for _ in range(25):
        base = fresh(rng.choice([3, 5, 12, 60, 200]))
        for _ in range(rng.randrange(1, 6)):
            near = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 3, 6])):
                near[rng.randrange(len(near))] = rng.choice(["X", "y"])
            rows.append(" ".join(near))
    base = fresh(120)
    for k in range(90):
        near = list(base)
        for at in rng.sample(range(120), k % 4):
            near[at] = f"e{rng.randrange(50)}"
        rows.append("\t".join(near) if k % 2 else " ".join(near).upper())
    chain = fresh(80)
    for k in range(20):  # each like the next, the ends not alike
        rows.append(" ".join(chain[k : k + 60]))
    rows += [None, "", "  \n", "one", "One", "word " * 50_000]
    out = [(i, t, "", 0, 0) for i, t in enumerate(rows)]
    rng.shuffle(out)
    out += [out[0], out[0], (out[1][0], " ".join(fresh(30)), "", 0, 0), (None, out[2][1], "", 0, 0), (None, "no id here at all", "", 0, 0)]
    return out


@pytest.mark.parametrize("seed, chunk", [(1, 512), (2, 7)])
def test_against_all_pairs(spark, seed, chunk, monkeypatch):
    monkeypatch.setattr(J, "CHUNK", chunk)
    rows = made(seed)
    docs = spark.createDataFrame(rows, SCHEMA)
    got = sorted((tuple(r)[:4] for r in J.similar_documents(docs).collect()), key=str)
    expected = sorted(plain(rows), key=str)
    assert got == expected
    kept = J.keep_one_of_each_group(docs)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(e[0]) for e in expected if e[0] == e[3])


def test_values_estimate_the_similarity():
    rng = np.random.default_rng(0)
    for overlap in (0.2, 0.5, 0.9):
        errors = []
        for _ in range(40):
            n = 300
            common = rng.integers(0, 2**63, int(2 * n * overlap / (1 + overlap))).astype(np.uint64)
            own = [rng.integers(0, 2**63, n - len(common)).astype(np.uint64) for _ in "ab"]
            values = np.concatenate([common, own[0], common, own[1]])
            sig = J.signatures(values, np.array([0, n, 2 * n]))
            errors.append((sig[0] == sig[1]).mean() - len(common) / (2 * n - len(common)))
        assert abs(np.mean(errors)) < 0.02 and np.std(errors) < 0.07


def test_pruning_rarely_drops_pairs_at_the_threshold():
    rng = np.random.default_rng(1)
    least = J.least_matches(0.8)
    equal = np.cumsum(rng.random((200_000, J.HASHES)) < 0.8, axis=1)
    dropped = np.zeros(len(equal), bool)
    for n in J.STEPS:
        dropped |= equal[:, n - 1] < least[n]
    assert dropped.mean() < 1e-4
    unlike = np.cumsum(rng.random((10_000, J.HASHES)) < 0.3, axis=1)
    assert (unlike[:, 31] < least[32]).mean() > 0.9


def test_pairs_and_counts():
    group = np.array([0, 0, 0, 1, 2, 2])
    found = [(a, b) for x, y in J.all_pairs(group) for a, b in zip(x.tolist(), y.tolist())]
    assert found == [(0, 1), (0, 2), (1, 2), (4, 5)]
    rng = np.random.default_rng(2)
    sets = [np.unique(rng.integers(0, 50, rng.integers(1, 40))).astype(np.uint64) for _ in range(12)]
    first = np.concatenate([[0], np.cumsum([len(s) for s in sets])])
    a, b = np.triu_indices(12, 1)
    got = J.common_counts(np.concatenate(sets), first, a, b)
    assert got.tolist() == [len(np.intersect1d(sets[x], sets[y])) for x, y in zip(a, b)]


def test_groups_stay_whole_across_batches():
    batches = [pa.RecordBatch.from_pydict({"k": k}) for k in ([1, 1], [1, 2], [], [2, 2, 2], [3], [3, 4])]
    tables = list(J.whole_groups(iter(batches), ["k"], 2))
    assert sum((t.column("k").to_pylist() for t in tables), []) == [1, 1, 1, 2, 2, 2, 2, 3, 3, 4]
    seen = defaultdict(int)
    for t in tables:
        for k in set(t.column("k").to_pylist()):
            seen[k] += 1
    assert set(seen.values()) == {1}


def test_empty(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert J.similar_documents(docs).collect() == [] and J.keep_one_of_each_group(docs).collect() == []


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    got = sorted(tuple(r) for r in op3_jaccard_join(spark, sf).collect())
    assert got == sorted(plain(rows))
