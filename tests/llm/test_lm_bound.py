"""op9 beyond the bound of its filter."""

import numpy as np
import pytest

from newsloom.llm import lm

from .test_lm import SCHEMA, held, made, plain_scores


@pytest.mark.parametrize("order, rate", [(2, 0.01), (3, 0.2), (2, 1e-9)])
def test_scores_are_the_same_whether_the_filter_is_broadcast_or_not(spark, order, rate):
    rows = made(150)
    docs = spark.createDataFrame(rows, SCHEMA)
    here, there = (lm.learn(docs, order=order, filter_bytes=b, rate=rate) for b in (1 << 30, 0))
    assert here.filter is not None and there.filter is None
    got, other = (sorted((tuple(r) for r in lm.score(docs, m).collect()), key=str) for m in (here, there))
    assert got == other
    if rate < 1e-6:
        expected = sorted(plain_scores(rows, order), key=str)
        assert np.allclose([g[5:] for g in got], [e[5:] for e in expected], rtol=1e-9)


def test_the_filter_grows_with_its_members(spark):
    sizes = [len(lm.learn(spark.createDataFrame(made(n), SCHEMA)).filter.data) for n in (50, 400)]
    assert sizes[1] > 2 * sizes[0]


def test_ngrams_seen_once_count(spark):
    assert lm.LEAST_COUNT == 1
    learned = [i for i in range(20) if not held(i)]
    base = " ".join(f"w{k}" for k in range(12))
    backwards = " ".join(f"w{k}" for k in reversed(range(12)))
    rows = [(learned[0], base, 0, 0.0), (next(i for i in range(20) if held(i)), base, 0, 0.0), (next(i for i in range(20, 99) if held(i)), backwards, 0, 0.0)]
    docs = spark.createDataFrame(rows, SCHEMA)
    got = {r.doc_id: r for r in lm.score(docs, lm.learn(docs, rate=1e-9)).collect()}
    same, other = got[rows[1][0]], got[rows[2][0]]
    assert np.isclose(same.base_score, other.base_score) and same.score > other.score + 0.1
