import random
import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from newsloom.llm.words import NOT_ALNUM, find_words, slices, window_hashes, word_hashes

TEXTS = st.lists(st.one_of(st.none(), st.text(alphabet="ab é\t\n\x0bAZ9.-ß漢\x85\xa0 ", max_size=30)), max_size=8)


def words_of(words):
    data = words.data.tobytes()
    found = [data[a:b].decode() for a, b in zip(words.starts, words.ends)]
    return [found[a:b] for a, b in zip(words.first[:-1], words.first[1:])]


@settings(max_examples=200, deadline=None)
@given(TEXTS)
def test_words(texts):
    column = pa.array(["skip", *texts], pa.string()).slice(1)
    assert words_of(find_words(column)) == [re.findall(r"[^\x20\x09-\x0D]+", t or "") for t in texts]
    lower = [re.sub("[A-Z]", lambda m: m[0].lower(), t or "") for t in texts]
    expected = [re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", t) for t in lower]
    assert words_of(find_words(column, NOT_ALNUM, lower=True)) == expected


def test_hashes_follow_the_words():
    rng = random.Random(1)
    texts = [" ".join(rng.choices(["a", "b", "ab", "ba", "", "aaaa"], k=rng.randrange(40))) for _ in range(300)]
    words = find_words(pa.array(texts))
    flat = [w for t in words_of(words) for w in t]
    hashes = word_hashes(words)
    assert len(set(zip(flat, hashes.tolist()))) == len(set(flat)) == len(set(hashes.tolist()))
    values, begins = window_hashes(words, hashes, 5)
    windows = [tuple(flat[b : b + 5]) for b in begins]
    assert len(windows) == sum(max(0, len(t) - 4) for t in words_of(words))
    assert len(set(zip(windows, values.tolist()))) == len(set(windows)) == len(set(values.tolist()))


def test_slices_keep_all_rows():
    batch = pa.RecordBatch.from_pydict({"text": ["x" * n for n in (0, 5, 50, 1, 1, 1, 0)] + [None]})
    pieces = list(slices(iter([batch, batch.slice(0, 0)]), "text", 7))
    assert sum((p.column("text").to_pylist() for p in pieces), []) == batch.column("text").to_pylist()
    assert max(p.num_rows for p in pieces) > 1
    assert np.all([sum(len(t or "") for t in p.column("text").to_pylist()) <= 7 or p.num_rows == 1 for p in pieces])
