import random
import zlib

import numpy as np
import pytest

from newsloom.llm import queries, quality
from newsloom.scratch import materialize

DOCS = "doc_id long, text string, label int, x string, score double"


def made(n, seed=0):
    rng = random.Random(seed)
    vocabulary = ["w" + "".join(rng.choices("abcdefgh", k=rng.randrange(1, 8))) for _ in range(400)]
    rows, labels = [], []
    for i in range(n):
        good = i % 3 > 0
        words = rng.choices(vocabulary, k=rng.randrange(5, 300))
        if not good:
            kind = i % 4
            words = [w.upper() + "!!" if kind == 0 else w + "%%%" if kind == 1 else words[0] if kind == 2 else w + " |" for w in words]
        rows.append((i, " ".join(words), 0, "clash", 0.5))
        labels.append((i, int(good), 0))
    return rows, labels


def test_scores_on_held_out_rows(spark):
    rows, labels = made(900)
    rows += [(10_000, None, 0, "", 0.0), (10_001, "", 0, "", 0.0), (None, "plain words here", 0, "", 0.0)]
    rows += [(10_002, "long word " * 300_000, 0, "", 0.0), rows[4], rows[4]]
    docs = spark.createDataFrame(rows, DOCS)
    wrong = [(i, 1 - q if zlib.crc32(str(i).encode()) % 5 == 0 else q, t) for i, q, t in labels]
    known = spark.createDataFrame([*wrong, (3, None, 0), (None, 0, 0), (5, 7, 0)], "doc_id long, quality int, toxic int")
    statistics = materialize(quality.statistics_table(docs), "t")
    got = quality.score_documents(statistics, quality.learn(statistics, known)).collect()
    assert len(got) == len(rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got)
    truth = {i: q for i, q, _ in labels}
    held = [r for r in got if r.held_out and r.doc_id in truth]
    assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    assert np.mean([r.predicted == truth[r.doc_id] for r in held]) > 0.98, "labels of the held-out fold were turned round"
    kept = quality.keep_good(docs, known)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id or -1 for r in kept.collect()) == sorted(r.doc_id or -1 for r in got if r.predicted)


def test_model_against_plain_gaussians():
    rng = np.random.default_rng(2)
    factors = np.stack([np.linalg.cholesky(np.cov(rng.normal(size=(3, 50)))) for _ in (0, 1)])
    model = quality.Model((2.0, 3.0), rng.normal(size=(2, 3)), factors)
    x = rng.normal(size=(20, 3))
    density = []
    for c in (0, 1):
        s = factors[c] @ factors[c].T
        d = x - model.means[c]
        density.append(model.sizes[c] * np.exp(-0.5 * np.einsum("ij,jk,ik->i", d, np.linalg.inv(s), d)) / np.sqrt(np.linalg.det(s)))
    assert np.allclose(model.scores(x), density[1] / (density[0] + density[1]))


def test_statistics_do_not_depend_on_the_batch():
    import pyarrow as pa

    texts = [r[1] for r in made(50)[0]] + ["", None, "a", "ÄÖ 1 ..", "\n"]
    whole = quality.document_statistics(pa.array(texts))
    single = np.concatenate([quality.document_statistics(pa.array([t], pa.string())) for t in texts])
    assert np.allclose(whole, single) and np.isfinite(whole).all()
    assert quality.document_statistics(pa.array([], pa.string())).shape == (0, len(quality.FEATURES))


@pytest.mark.parametrize("quality_of", [None, 0, 1])
def test_labels_of_one_class_or_none(spark, quality_of):
    docs = spark.createDataFrame(made(20)[0], DOCS)
    known = spark.createDataFrame([] if quality_of is None else [(i, quality_of, 0) for i in range(20)], "doc_id long, quality int, toxic int")
    statistics = quality.statistics_table(docs)
    got = quality.score_documents(statistics, quality.learn(statistics, known)).collect()
    assert {r.score for r in got} == {0.5 if quality_of is None else float(quality_of)}


def test_empty(spark):
    docs = spark.createDataFrame([], DOCS)
    known = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert quality.keep_good(docs, known).collect() == []


def test_query(spark):
    sf = "/root/testdata/sf0.01"
    got = {r.doc_id: r for r in queries.op4_quality(spark, sf).collect()}
    labels = spark.read.parquet(f"{sf}/labels.parquet").collect()
    assert len(got) == 1000
    held = [(got[r.doc_id].predicted, r.quality) for r in labels if got[r.doc_id].held_out]
    assert np.mean([a == b for a, b in held]) > 0.97
