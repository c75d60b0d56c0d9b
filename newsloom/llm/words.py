"""Words of whole Arrow text batches as numpy arrays: places and 64-bit hashes."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa

#: Bytes of text that are worked on at once, unless a single text is longer.
SLICE_BYTES = 1 << 20

#: Byte classes. Words of white-space texts: anything but blank, tab, line feed, vertical tab, form feed, return.
BLANK = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])
#: Separators of alphanumeric words in text whose A-Z are lower-cased: ASCII but digits and a-z.
NOT_ALNUM = np.array([b < 0x80 and not chr(b).isdigit() and not "a" <= chr(b) <= "z" for b in range(256)])
LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)

_BASE = 0x9E3779B97F4A7C15 | 1
_MASK = (1 << 64) - 1


@dataclass
class Words:
    """Words of ``texts``; those of text i are ``first[i]`` to ``first[i + 1]``."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray
    text_at: np.ndarray

    @property
    def count(self) -> np.ndarray:
        return np.diff(self.first)

    def text_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.count)


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts in a row and where each begins (n + 1 places). Null texts are empty."""
    texts = texts.cast(pa.large_binary()).fill_null(b"")
    _, places, data = texts.buffers()
    at = np.frombuffer(places, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    everything = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return everything[at[0] : at[-1]], at - at[0]


def find_words(texts: pa.Array, separators: np.ndarray = BLANK, lower: bool = False) -> Words:
    data, at = text_bytes(texts)
    if lower:
        data = LOWER[data]
    n = len(data)
    inside = np.zeros(n + 2, bool)
    inside[1:-1] = ~separators[data]
    border = np.zeros(n + 1, bool)
    border[at] = True
    starts = np.flatnonzero(inside[1:-1] & (~inside[:-2] | border[:-1]))
    ends = np.flatnonzero(inside[1:-1] & (~inside[2:] | border[1:])) + 1
    return Words(data, starts, ends, np.searchsorted(starts, at), at)


@cache
def _trim():
    """What the C library has for giving freed memory back, if it has it."""
    return getattr(ctypes.CDLL(None), "malloc_trim", lambda _: 0)


def give_back() -> None:
    """Return freed memory to the system: workers live on between tasks, beside a JVM that needs the room."""
    pa.default_memory_pool().release_unused()
    _trim()(0)


def slices(batches: Iterator[pa.RecordBatch], column: str, max_bytes: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows of ``batches`` in pieces of at most ``max_bytes`` of text, one row at least.

    At the end the worker gives back what it keeps for later, see ``give_back``.
    """
    for batch in batches:
        if batch.num_rows == 0:
            continue
        _, at = text_bytes(batch.column(column))
        begin = 0
        while begin < batch.num_rows:
            end = max(begin + 1, int(np.searchsorted(at, at[begin] + max_bytes, "right")) - 1)
            end = min(end, batch.num_rows)
            yield batch.slice(begin, end - begin)
            begin = end
    give_back()


@cache
def _power_tables(size: int, base: int) -> tuple[np.ndarray, np.ndarray]:
    up, down = np.full(size, base, np.uint64), np.full(size, pow(base, -1, 1 << 64), np.uint64)
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


def powers(size: int, base: int = _BASE) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i < size."""
    up, down = _power_tables(1 << max(10, int(size - 1).bit_length()), base)
    return up[:size], down[:size]


def mix(values: np.ndarray, seed: int = 0) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    with np.errstate(over="ignore"):
        x = values + np.uint64((0x632BE59BD9B4E019 * (seed + 1)) & _MASK)
        x ^= x >> np.uint64(30)
        x *= np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(27)
        x *= np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def span_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int = _BASE) -> np.ndarray:
    """For each span a hash of ``values[start:end]`` that doesn't depend on where it lies."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    up, down = powers(len(values) + 1, base)
    sums = np.zeros(len(values) + 1, np.uint64)
    with np.errstate(over="ignore"):
        np.cumsum((values.astype(np.uint64) + np.uint64(1)) * up[: len(values)], out=sums[1:])
        own = (sums[ends] - sums[starts]) * down[starts]
        return mix(own + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def word_hashes(words: Words) -> np.ndarray:
    return span_hashes(words.data, words.starts, words.ends)


def window_hashes(words: Words, hashes: np.ndarray, size: int, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Hash and first word of every run of ``size`` words that lies in one text."""
    begins = np.arange(max(0, len(hashes) - size + 1))
    text = words.text_of_word()
    begins = begins[text[begins] == text[begins + size - 1]] if len(begins) else begins
    return span_hashes(mix(hashes, 7 + seed), begins, begins + size, (_BASE + 2 * seed) | 1), begins
