import numpy as np
from hypothesis import given
from hypothesis import strategies as st

from newsloom.llm import units as U

KEYS = st.lists(st.integers(0, 2**64 - 1), max_size=60)


@given(KEYS)
def test_numbers_come_back(values):
    numbers = np.array(values, np.uint64)
    assert U.unpack_numbers(U.pack_numbers(numbers)).tolist() == values
    assert U.unpack_sorted(U.pack_sorted(np.sort(numbers))).tolist() == sorted(values)


@given(KEYS)
def test_buckets_hold_all_keys(values):
    keys = np.array(values, np.uint64)
    order, rest, begins = U.by_bucket(keys, 8)
    back = []
    for b in range(8):
        part = rest[begins[b] : begins[b + 1]]
        assert (np.diff(part.astype(object)) >= 0).all()
        back += U.whole_keys(part, b, 8).tolist()
    assert sorted(back) == sorted(values) and keys[order].tolist() == back
