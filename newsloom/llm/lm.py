"""Language-model scoring with n-gram counts in a log-frequency Bloom filter.

Counts are quantised on a log scale; an n-gram of level q is a member q times, as
(n-gram, 1) to (n-gram, q), so its count is read back by probing level after level
until one is missing. Errors are one-sided: an n-gram is never taken for rarer than
its level, and with the filter's false-positive rate for one level more frequent.

The filter grows with the members: each bucket of n-grams counts its own and sizes its
segment for ``FALSE_POSITIVES``. Where all segments are within the bound of what is
broadcast, workers probe them; beyond it each bucket probes its segment for the n-grams
that the units ask about. Scores come from the same probes either way.

Unigram counts are exact. Units of documents ask the buckets for the counts of
their distinct words, which answer each unit with one message.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.llm import units as U
from newsloom.llm.words import LOWER, find_words, mix, slices, text_bytes, word_hashes
from newsloom.scratch import materialize

FOLDS, HELD_OUT = 7, 2
#: Bytes of the filter up to which it is broadcast, and the false positives of one level that it may have.
FILTER_BYTES = 32 << 20
FALSE_POSITIVES = 0.01
PROBES = 3
#: n-grams seen less often are not members, and each level stands for counts twice as high.
LEAST_COUNT = 1
LEVEL_BASE = 2.0
#: Weight of a long history's estimate against the next shorter one's, and the observations of
#: the history at which it has half of that.
TRUST, EVIDENCE = 0.3, 5.0

END = np.uint64(0x9AE16A3B2F90404F)
START = np.uint64(0xC3A5C85C97CB3127)


def held_out(key: Column) -> Column:
    """Rows that are never learned from; a row without key is learned from."""
    return F.coalesce(F.crc32(key.cast("string")) % FOLDS == HELD_OUT, F.lit(False))


@dataclass
class Tokens:
    """Hashes of all texts in a row, ``START`` before and ``END`` after each; text i begins at ``first[i]``."""

    values: np.ndarray
    first: np.ndarray

    @property
    def is_start(self) -> np.ndarray:
        flags = np.zeros(len(self.values), bool)
        flags[self.first[:-1]] = True
        return flags


def tokens_of(texts: pa.Array) -> Tokens:
    data, at = text_bytes(texts)
    lowered = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(texts), [None, pa.py_buffer(at.astype(np.int64)), pa.py_buffer(LOWER[data])]
    )
    words = find_words(lowered)
    first = words.first + 2 * np.arange(len(words.first))
    values = np.empty(first[-1], np.uint64)
    place = np.ones(first[-1], bool)
    place[first[:-1]] = place[first[1:] - 1] = False
    values[place] = word_hashes(words)
    values[first[:-1]], values[first[1:] - 1] = START, END
    return Tokens(values, first)


def ngram_keys(tokens: Tokens, order: int) -> list[np.ndarray]:
    """Keys of the n-grams that end at each token, for n = 2 to ``order``; histories stop at ``START``."""
    values, starts = tokens.values, np.repeat(tokens.first[:-1], np.diff(tokens.first))
    keys, out = mix(values, 1), []
    for back in range(1, order):
        place = np.arange(len(values)) - back
        earlier = np.where(place >= starts, values[np.maximum(place, 0)], START)
        keys = mix(keys + mix(earlier, 2 + back), 1)
        out.append(keys)
    return out


def levels(counts: np.ndarray) -> np.ndarray:
    """Quantised counts: 0 below ``LEAST_COUNT``, then 1, 2, ... on a log scale."""
    safe = np.maximum(counts, LEAST_COUNT).astype(float)
    return np.where(counts >= LEAST_COUNT, 1 + np.floor(np.log(safe / LEAST_COUNT) / np.log(LEVEL_BASE) + 1e-9), 0).astype(int)


def count_of_level(level: np.ndarray) -> np.ndarray:
    """Middle of the counts that share a level; 0 for level 0."""
    return np.where(level > 0, LEAST_COUNT * LEVEL_BASE ** (level - 1) * np.sqrt(LEVEL_BASE), 0.0)


def bit_places(keys: np.ndarray, level: int, bits: np.ndarray) -> np.ndarray:
    """(keys, PROBES) places of the member (key, level) in the segment of each key, of ``bits`` bits."""
    first = mix(keys ^ mix(np.array([level], np.uint64), 5), 6)
    step = mix(first, 7) | np.uint64(1)
    probes = np.arange(PROBES, dtype=np.uint64)
    return ((first[:, None] + step[:, None] * probes) >> np.uint64(11)) % bits[:, None]


def segment_bytes(members: int, rate: float) -> int:
    """Bytes of a segment that takes another key for a member at this rate."""
    return 8 + int(-PROBES * members / np.log1p(-(rate ** (1 / PROBES)))) // 8


def fill(keys: np.ndarray, counts: np.ndarray, rate: float = FALSE_POSITIVES) -> np.ndarray:
    """The bytes of a segment with all levels of ``keys``, sized for the rate."""
    level = levels(counts)
    bits = np.zeros(segment_bytes(int(level.sum()), rate) * 8, bool)
    for n in range(1, int(level.max(initial=0)) + 1):
        some = keys[level >= n]
        bits[bit_places(some, n, np.full(len(some), len(bits), np.uint64)).ravel()] = True
    return np.packbits(bits, bitorder="little")


@dataclass
class Filter:
    """Segments in a row, one for each bucket; that of bucket b is ``data[begins[b]:begins[b + 1]]``, empty if it has no members."""

    data: np.ndarray
    begins: np.ndarray

    def level(self, keys: np.ndarray) -> np.ndarray:
        """The level of each whole key, from probes of its bucket's segment."""
        buckets = len(self.begins) - 1
        bucket = (keys & np.uint64(buckets - 1)).astype(np.int64)
        rest = keys >> np.uint64(buckets.bit_length() - 1)
        bits = (np.diff(self.begins)[bucket] * 8).astype(np.uint64)
        found = np.zeros(len(keys), np.int64)
        alive = np.flatnonzero(bits > 0)
        for n in range(1, 64):
            places = bit_places(rest[alive], n, bits[alive])
            byte = self.data[self.begins[bucket[alive]][:, None] + (places >> np.uint64(3)).astype(np.int64)]
            hit = ((byte >> (places & np.uint64(7)).astype(np.uint8)) & 1).all(axis=1)
            alive = alive[hit]
            if not len(alive):
                break
            found[alive] = n
        return found

    @property
    def full(self) -> float:
        return float(np.unpackbits(self.data).mean())


# --- counting ----------------------------------------------------------------

WORD, NGRAM, BITS, TOTAL = 0, 1, 2, 3
MESSAGE = "kind int, bucket int, unit int, keys binary, counts binary"


def unit_messages(table: pa.Table, unit: int, buckets: int, order: int) -> Iterator[tuple]:
    """A unit's distinct words and n-grams with their counts in the training rows."""
    words: list[np.ndarray] = []
    weights: list[np.ndarray] = []
    grams: list[np.ndarray] = []
    gram_weights: list[np.ndarray] = []
    for rows in slices(iter(table.to_batches()), "text"):
        tokens = tokens_of(rows.column("text"))
        learned = ~np.asarray(rows.column("held_out").to_numpy(zero_copy_only=False), bool)
        weight = np.repeat(learned, np.diff(tokens.first))
        real = ~tokens.is_start
        words.append(tokens.values[real])
        weights.append(weight[real])
        for k in ngram_keys(tokens, order):
            grams.append(k[real])
            gram_weights.append(weight[real])
    for kind, own, seen in ((WORD, words, weights), (NGRAM, grams, gram_weights)):
        if own:
            keys, place = np.unique(np.concatenate(own), return_inverse=True)
            counts = np.bincount(place, np.concatenate(seen), len(keys)).astype(np.uint64)
            yield from messages(kind, keys, counts, unit, buckets)


def messages(kind: int, keys: np.ndarray, counts: np.ndarray, unit: int, buckets: int) -> Iterator[tuple]:
    order, rest, begins = U.by_bucket(keys, buckets)
    counts = counts[order]
    for bucket in np.flatnonzero(np.diff(begins)).tolist():
        part = slice(begins[bucket], begins[bucket + 1])
        yield kind, bucket, unit, U.pack_sorted(rest[part]), U.pack_numbers(counts[part])


def answer_bucket(table: pa.Table, buckets: int, filter_bytes: int, rate: float) -> Iterator[tuple]:
    """The segment of the bucket, counts of the words and levels of the n-grams of each unit, and totals of the bucket.

    Levels are what probes of the segment tell, in the order in which the unit asked. A segment
    whose share of the whole filter is too large for a broadcast stays with the bucket.
    """
    kinds, unit_ids = (table.column(c).to_numpy() for c in ("kind", "unit"))
    bucket = int(table.column("bucket")[0].as_py())
    packed = list(zip(U.binary(table.column("keys")), U.binary(table.column("counts")), strict=True))
    rest = {k: [U.unpack_sorted(packed[i][0]) for i in np.flatnonzero(kinds == k)] for k in (WORD, NGRAM)}
    seen = {k: [U.unpack_numbers(packed[i][1]) for i in np.flatnonzero(kinds == k)] for k in (WORD, NGRAM)}
    keys, counts = U.summed(rest[NGRAM], seen[NGRAM])
    segment = fill(keys[counts >= LEAST_COUNT], counts[counts >= LEAST_COUNT], rate)
    level = Filter(segment, np.array([0, len(segment)])).level(keys)
    for unit, own in zip(unit_ids[kinds == NGRAM].tolist(), rest[NGRAM], strict=True):
        yield NGRAM, bucket, unit, b"", level[np.searchsorted(keys, own)].astype(np.uint8).tobytes()
    small = len(segment) * buckets <= 2 * filter_bytes
    yield BITS, bucket, -1, segment.tobytes() if small else b"", b""
    keys, counts = U.summed(rest[WORD], seen[WORD])
    totals = [counts.sum(), (counts > 0).sum(), len(segment), not small]
    yield TOTAL, bucket, -1, b"", U.pack_numbers(np.array(totals, np.uint64))
    for unit, own in zip(unit_ids[kinds == WORD].tolist(), rest[WORD], strict=True):
        found = counts[np.searchsorted(keys, own)]
        yield WORD, bucket, unit, U.pack_sorted(own), U.pack_numbers(found)


MESSAGE_SCHEMA = pa.schema(
    [("kind", pa.int32()), ("bucket", pa.int32()), ("unit", pa.int32()), ("keys", pa.binary()), ("counts", pa.binary())]
)


@dataclass
class Model:
    answers: DataFrame  # (kind, unit, bucket, keys, counts): counts of each unit's words, and levels of its n-grams without filter
    filter: Filter | None
    train_tokens: int
    vocabulary: int
    units: int
    buckets: int
    order: int


def learn(
    docs: DataFrame, order: int = 2, filter_bytes: int = FILTER_BYTES, key: str = "doc_id", rate: float = FALSE_POSITIVES
) -> Model:
    """Count the words and n-grams of the rows of ``docs`` outside the held-out fold.

    The stored answers hold a few bytes for each distinct word of a unit and one for each
    distinct n-gram. The filter's size follows from its members and ``rate``, its false
    positives; it comes to the driver and is broadcast up to ``filter_bytes``.
    """
    units, buckets = U.plan_sizes(docs)
    text = docs.select(U.unit_of(F.col(key), units).alias("unit"), held_out(F.col(key)).alias("held_out"), "text")

    def ask(key_: tuple, table: pa.Table) -> pa.Table:
        return U.rows_to_table(unit_messages(table, key_[0].as_py(), buckets, order), MESSAGE_SCHEMA)

    def answer(table: pa.Table) -> pa.Table:
        return U.rows_to_table(answer_bucket(table, buckets, filter_bytes, rate), MESSAGE_SCHEMA)

    asked = text.groupBy("unit").applyInArrow(ask, MESSAGE)
    answers = materialize(asked.groupBy("bucket").applyInArrow(answer, MESSAGE), "lm")
    totals = answers.filter(F.col("kind") == TOTAL).select("counts")

    @F.arrow_udf("array<long>")
    def numbers(column: pa.Array) -> pa.Array:
        return pa.array([[int(n) for n in U.unpack_numbers(x)] for x in column.to_pylist()], pa.list_(pa.int64()))

    each = [F.sum(F.col("n")[at]) for at in range(4)]
    tokens, vocabulary, size, omitted = (int(n or 0) for n in totals.select(numbers("counts").alias("n")).agg(*each).first())
    filter_ = None
    if not omitted and size <= filter_bytes:
        # A row for each bucket.
        rows = {r.bucket: bytes(r["keys"]) for r in answers.filter(F.col("kind") == BITS).select("bucket", "keys").collect()}
        sizes = [len(rows.get(b, b"")) for b in range(buckets)]
        data = np.frombuffer(b"".join(rows[b] for b in sorted(rows)), np.uint8)
        filter_ = Filter(data, np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64))
    own = answers.filter(F.col("kind") == WORD if filter_ else F.col("kind").isin(WORD, NGRAM))
    return Model(own.select("kind", "unit", "bucket", "keys", "counts"), filter_, tokens, vocabulary, units, buckets, order)


# --- scoring -----------------------------------------------------------------

SCORES = "n_tokens long, n_known long, train_tokens long, base_score double, score double"


def per_text(values: np.ndarray, tokens: Tokens) -> np.ndarray:
    """Sums of ``values`` over the tokens of each text."""
    return np.add.reduceat(values, tokens.first[:-1]) if len(tokens.first) > 1 else np.zeros(0)


@dataclass
class Answered:
    """The levels of a unit's n-grams as the buckets' segments told them."""

    keys: np.ndarray
    levels: np.ndarray

    def level(self, keys: np.ndarray) -> np.ndarray:
        place = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[place] == keys, self.levels[place], 0)


def answered(texts: pa.Table, answers: list[tuple[int, bytes]], buckets: int, order: int) -> Answered:
    """The answers (bucket, levels) to what ``unit_messages`` asked for the same texts."""
    grams = [np.zeros(0, np.uint64)]
    for rows in slices(iter(texts.to_batches()), "text"):
        tokens = tokens_of(rows.column("text"))
        grams += [k[~tokens.is_start] for k in ngram_keys(tokens, order)]
    keys = np.unique(np.concatenate(grams))
    in_order, _, begins = U.by_bucket(keys, buckets)
    level = np.zeros(len(keys), np.uint8)
    for bucket, found in answers:
        level[in_order[begins[bucket] : begins[bucket + 1]]] = np.frombuffer(found, np.uint8)
    return Answered(keys, level)


def text_scores(tokens: Tokens, counts: np.ndarray, filter_: Filter | Answered, total: int, vocabulary: int, order: int) -> list:
    """(n_tokens, n_known, base_score, score) of each text; ``counts`` are those of the words at each place."""
    real = ~tokens.is_start
    base = (counts + 1) / (total + vocabulary + 1)
    chance = base
    history = np.concatenate([[0.0], counts[:-1].astype(float)])
    for keys in ngram_keys(tokens, order):
        seen = np.minimum(count_of_level(filter_.level(keys)), np.minimum(counts, history))
        trust = TRUST * history / (history + EVIDENCE)
        chance = trust * seen / np.maximum(history, 1) + (1 - trust) * chance
        history = np.concatenate([[0.0], seen[:-1]])
    logs = [np.where(real, np.log10(np.maximum(x, 1e-300)), 0.0) for x in (base, chance)]
    return [per_text(real.astype(np.int64), tokens), per_text((real & (counts > 0)).astype(np.int64), tokens)] + [
        per_text(x, tokens) for x in logs
    ]


def score(docs: DataFrame, model: Model, key: str = "doc_id") -> DataFrame:
    """(key, held_out, n_tokens, n_known, train_tokens, base_score, score) for every row of ``docs``.

    ``base_score`` is the add-one unigram score, ``score`` the log10 probability of
    the text by the model: each order's estimate is interpolated with the next shorter
    one's, the more trusted the more often its history was seen. ``docs`` must be the table that
    ``model`` was asked about. Null texts are empty: their end alone is scored.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model.filter) if model.filter else None
    total, vocabulary, buckets, order = model.train_tokens, model.vocabulary, model.buckets, model.order
    kind = docs.schema[key].dataType.simpleString()
    schema = f"{key} {kind}, held_out boolean, {SCORES}"

    def work(key_: tuple, texts: pa.Table, answers: pa.Table) -> pa.Table:
        grams = answers.filter(pc.equal(answers.column("kind"), NGRAM))
        answers = answers.filter(pc.equal(answers.column("kind"), WORD))
        if shared:
            filter_ = shared.value
        else:
            filter_ = answered(texts, [*zip(grams.column("bucket").to_pylist(), U.binary(grams.column("counts")))], buckets, order)
        known, found = [np.zeros(0, np.uint64)], [np.zeros(0, np.uint64)]
        for bucket, k, c in zip(
            answers.column("bucket").to_pylist(), U.binary(answers.column("keys")), U.binary(answers.column("counts")), strict=True
        ):
            known.append(U.whole_keys(U.unpack_sorted(k), bucket, buckets))
            found.append(U.unpack_numbers(c))
        keys, counts = np.concatenate(known), np.concatenate(found)
        by_key = np.argsort(keys)
        keys, counts = keys[by_key], counts[by_key]
        # A history of nothing but the start has been seen once for each text, as often as their end.
        ends = counts[np.searchsorted(keys, END)] if len(keys) else 0
        parts = []
        for rows in slices(iter(texts.to_batches()), "text"):
            tokens = tokens_of(rows.column("text"))
            place = np.minimum(np.searchsorted(keys, tokens.values), len(keys) - 1)
            at = np.where(tokens.is_start, ends, counts[place]).astype(np.int64)
            n_tokens, n_known, base, full = text_scores(tokens, at, filter_, total, vocabulary, order)
            parts.append(
                pa.table(
                    {
                        key: rows.column(key),
                        "held_out": rows.column("held_out"),
                        "n_tokens": pa.array(n_tokens, pa.int64()),
                        "n_known": pa.array(n_known, pa.int64()),
                        "train_tokens": pa.array(np.full(len(base), total), pa.int64()),
                        "base_score": pa.array(base, pa.float64()),
                        "score": pa.array(full, pa.float64()),
                    }
                )
            )
        return pa.concat_tables(parts) if parts else pa.table({c: [] for c in schema.split()[::2]})

    text = docs.select(U.unit_of(F.col(key), model.units).alias("unit"), key, held_out(F.col(key)).alias("held_out"), "text")
    return text.groupBy("unit").cogroup(model.answers.groupBy("unit")).applyInArrow(work, schema)
