import random
import zlib
from collections import Counter, defaultdict
from functools import cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from newsloom.llm import packing
from newsloom.llm.packing import WordIds, best_configuration, plan_sequences, token_pieces
from newsloom.llm.queries import op8_packing, tokenizer_path
from newsloom.scratch import materialize


@pytest.fixture(scope="module")
def path():
    pytest.importorskip("public_tokenizers")
    return tokenizer_path()


@cache
def own_tokenizer(path):
    return Tokenizer.from_file(path)


def plain_ids(path, text):
    return [*own_tokenizer(path).encode(text or "", add_special_tokens=False).ids, 1]


ODD = "\ue000\uf8ffaTKé̈́İẞσΣ'sS.,!&|≠ \t\n\x0b\x85\xa0 漢😀٣1<|endoftext|>~`"


@settings(max_examples=400, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet=ODD, max_size=25), st.text(max_size=12)), max_size=5))
def test_ids_are_those_of_the_whole_text(texts):
    words = WordIds(tokenizer_path())
    ids, at = words.of_texts(pa.array(texts, pa.string()))
    got = [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:])]
    assert got == [plain_ids(words.path, t) for t in texts]


def test_best_of_pieces():
    rng = np.random.default_rng(2)
    for _ in range(20):
        need, value = rng.integers(0, 3, 12), rng.random(12)
        need[0] = 0
        got = packing.best_of_pieces(value, need, 15)
        assert (got <= need).all() and got @ np.arange(12) <= 15
        pieces = np.repeat(np.arange(12), need)
        sums = [(sum(value[p] for p in c)) for n in range(len(pieces) + 1) for c in combinations(pieces, n) if sum(c) <= 15]
        assert got @ value == pytest.approx(max(sums))


def test_special_tokens_are_the_tokenizers_own(path):
    texts = ["a <|endoftext|> b", "x<|ENDOFTEXT|>y", "<|startoftext|><|endoftext|>", "no special token", None, "a <| endoftext|> b", "<|endoftext|>" * 3]
    ids, at = WordIds(path).of_texts(pa.array(texts))
    got = [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:])]
    assert got == [plain_ids(path, t) for t in texts] and got[0] == [320, 49407, 321, 1]


def test_few_pieces_are_planned_by_the_program_too(monkeypatch):
    rng = np.random.default_rng(1)
    histogram = np.bincount(np.minimum(4095, rng.lognormal(6, 1, 200).astype(int) + 1), minlength=4097)
    left = {}
    monkeypatch.setattr(packing, "best_fit", lambda h, capacity, plain=packing.best_fit: left.setdefault("pieces", int(h.sum())) and plain(h, capacity) or ())
    plan = plan_sequences(histogram)
    assert left.get("pieces", 0) < 0.5 * 200
    assert sum(n * sum(c.values()) for c, n in plan.rows) == 200
    assert plan.sequences <= -(-int((histogram * np.arange(4097)).sum()) // 4096) + 1


def test_forgetting_changes_nothing(monkeypatch, path):
    monkeypatch.setattr(packing, "REMEMBERED_WORDS", 20)
    words, rng = WordIds(path), random.Random(3)
    for _ in range(30):
        text = " ".join("".join(rng.choices("abcXé.", k=rng.randrange(1, 6))) for _ in range(15))
        ids, _ = words.of_texts(pa.array([text]))
        assert ids.tolist() == plain_ids(path, text)


def check_packed(rows, capacity):
    by = defaultdict(list)
    for r in rows:
        by[r.sequence_id].append((r.offset, r.length))
    for places in by.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by)


def test_pieces_and_places(spark, path):
    rng = random.Random(5)
    rows = [(i, " ".join(rng.choices("alpha beta, Gamma. delta'll x9".split(), k=rng.choice([1, 3, 9, 60]))), "x", 0) for i in range(800)]
    rows += [(900, None, "x", 0), (901, "", "x", 0), (902, "word " * 5000, "x", 0), (7, "again", "x", 0), (7, "again", "x", 0), (None, "no key", "x", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, length string, sequence_id int")
    pieces = materialize(token_pieces(docs, path, 128, with_ids=True), "t")
    ids = defaultdict(list)
    for r in pieces.collect():
        assert r.length == len(r.ids) and r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
        ids[r.doc_id].append((r.start, r.piece, r.ids))
    for i in {r[0] for r in rows} - {7}:
        found = sorted(ids[i])
        assert sum((x[2] for x in found), []) == plain_ids(path, next(r[1] for r in rows if r[0] == i))
        assert [x[1] for x in found] == list(range(len(found))) and all(len(x[2]) == 128 for x in found[:-1])
    got = packing.pack(pieces.drop("ids"), 128).collect()
    assert Counter((r.doc_id, r.piece) for r in got) == Counter((r.doc_id, r.piece) for r in pieces.collect())
    sequences = check_packed(got, 128)
    assert sequences <= 1.02 * -(-sum(r.length for r in got) // 128) + 1


def test_best_configuration_against_all():
    rng = np.random.default_rng(0)
    for _ in range(20):
        value = np.where(rng.random(13) < 0.5, rng.random(13), 0)
        value[0] = 0

        def best(room):
            return max([0.0] + [value[n] + best(room - n) for n in range(1, room + 1) if value[n] > 0])

        counts = best_configuration(value, 12)
        assert np.isclose((counts * value).sum(), best(12)) and (counts * np.arange(13)).sum() <= 12


@pytest.mark.parametrize("sizes", [[34, 66], [51], [40, 30, 30], [1], [26, 27, 47], [100], []])
def test_plans_cover_exactly_and_are_near_the_bound(sizes):
    histogram = np.zeros(101, np.int64)
    for s in sizes:
        histogram[s] += 30_000
    plan = plan_sequences(histogram, 100)
    used = Counter()
    for counts, n in plan.rows:
        assert sum(length * c for length, c in counts.items()) <= 100
        for length, c in counts.items():
            used[length] += c * n
    assert used == Counter({s: 30_000 * c for s, c in Counter(sizes).items()})
    bound = {(34, 66): 30_000, (51,): 30_000, (40, 30, 30): 30_000, (1,): 300, (26, 27, 47): 30_000, (100,): 30_000, (): 0}
    assert plan.sequences <= 1.01 * bound[tuple(sizes)]


def test_linear_program_is_no_worse_than_best_fit():
    histogram = np.zeros(101, np.int64)
    histogram[[48, 26, 25]] = 20_000, 20_000, 40_000
    lp = plan_sequences(histogram, 100).sequences
    greedy = sum(n for _, n in packing.best_fit(histogram, 100))
    assert lp <= greedy


def test_empty_and_query(spark, path):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert packing.pack_documents(docs, path).collect() == []
    sf = "/root/testdata/sf0.001"
    got = op8_packing(spark, sf).collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    expected = Counter()
    for i, t in texts.items():
        ids = plain_ids(path, t)
        for n, at in enumerate(range(0, len(ids), 4096)):
            part = ids[at : at + 4096]
            expected[i, n, at, len(part), zlib.crc32(np.array(part, "<u4").tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == expected
    assert check_packed(got, 4096) <= 1.01 * -(-sum(r.length for r in got) // 4096) + 1


def test_texts_are_coded_in_small_slices(spark, monkeypatch, path):
    seen, whole = [], WordIds.of_texts
    texts = ["word and more. " * 40_000] * 4
    monkeypatch.setattr(WordIds, "of_texts", lambda self, t: seen.append(t.nbytes) or whole(self, t))
    rows = pa.RecordBatch.from_pydict({"doc_id": list(range(4)), "text": texts})
    for part in packing.slices([rows], "text", packing.CODED_BYTES):
        WordIds(path).of_texts(part.column("text"))
    assert len(seen) == 4 and max(seen) <= 1 << 20
