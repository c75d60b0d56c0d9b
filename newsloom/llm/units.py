"""Exchanges of hashed keys between units of documents and buckets of keys.

A unit is a bounded group of documents, a bucket a range of hash values. Instead
of a row for each key, a unit sends each bucket one message with its distinct keys,
sorted and stored as differences. So keys are combined before the shuffle, a key
that occurs everywhere costs one entry for each unit, and messages shrink to a few
bytes a key.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: UTF-8 bytes of text in a unit and in the texts that a bucket serves, on average.
UNIT_BYTES = 3 << 20
BUCKET_BYTES = 8 << 20
#: Fewest units and buckets, so that small inputs are spread as well.
LEAST = 64


def plan_sizes(docs: DataFrame) -> tuple[int, int]:
    """(units, buckets) for the texts of ``docs``; buckets are a power of two."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    units = max(LEAST, -(-size // UNIT_BYTES))
    buckets = max(LEAST, -(-size // BUCKET_BYTES))
    return int(units), 1 << int(buckets - 1).bit_length()


def unit_of(key: Column, units: int) -> Column:
    """Rows of the same key share a unit."""
    return F.pmod(F.xxhash64(key), F.lit(units)).cast("int")


def pack_numbers(values: np.ndarray) -> bytes:
    """Whole numbers in as few bytes each as the largest needs, byte by byte across all of them."""
    if not len(values):
        return b""
    width = max(1, -(-int(values.max()).bit_length() // 8))
    planes = values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width]
    return bytes([width]) + planes.T.tobytes()


def unpack_numbers(data: bytes) -> np.ndarray:
    if not data:
        return np.zeros(0, np.uint64)
    width = data[0]
    planes = np.frombuffer(data, np.uint8, offset=1).reshape(width, -1)
    out = np.zeros((planes.shape[1], 8), np.uint8)
    out[:, :width] = planes.T
    return out.view("<u8").ravel()


def pack_sorted(keys: np.ndarray) -> bytes:
    """``pack_numbers`` of the differences of ascending keys."""
    return pack_numbers(np.diff(keys, prepend=np.uint64(0)))


def unpack_sorted(data: bytes) -> np.ndarray:
    return np.cumsum(unpack_numbers(data), dtype=np.uint64)


def by_bucket(keys: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order that sorts ``keys`` by bucket (their low bits) and then value; the sorted values without
    bucket bits; where each bucket begins (buckets + 1 places)."""
    bits = np.uint64(buckets.bit_length() - 1)
    bucket = (keys & np.uint64(buckets - 1)).astype(np.int64)
    order = np.lexsort((keys, bucket))
    begins = np.searchsorted(bucket[order], np.arange(buckets + 1))
    return order, keys[order] >> bits, begins


def whole_keys(rest: np.ndarray, bucket: int, buckets: int) -> np.ndarray:
    """The keys whose bucket bits ``by_bucket`` took off."""
    return (rest << np.uint64(buckets.bit_length() - 1)) | np.uint64(bucket)


def binary(column: pa.ChunkedArray) -> list[bytes]:
    return [x or b"" for x in column.to_pylist()]


def summed(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys with their counts added up."""
    if not keys:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    distinct, place = np.unique(np.concatenate(keys), return_inverse=True)
    return distinct, np.bincount(place, np.concatenate(counts).astype(float), len(distinct)).astype(np.uint64)


def rows_to_table(rows: Iterator[tuple], schema: pa.Schema) -> pa.Table:
    columns = list(zip(*rows)) or [[] for _ in schema]
    return pa.table([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)
