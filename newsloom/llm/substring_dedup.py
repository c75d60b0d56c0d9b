"""Removal of repeated passages, found by fixed-block anchors.

The reference blocks are non-overlapping runs of ``BLOCK`` words of every document;
every rolling window of as many words probes them. A run of ``WINDOW`` words holds
a whole block wherever it lies, so a run that occurs twice has its block hit by a
probe from the other place. Hits are extended to all runs around the block, runs
are compared by their full hashes, and runs that overlap or touch make up the
maximal exact repeats.

Documents are held in units, and units exchange sorted, difference-coded hashes
with buckets (see ``units``): a probe costs two to three bytes, an answer less, and
a passage that occurs in every document costs a unit one entry. The texts are
shuffled once, into a bucketed table that all three passes read in place. A task
holds one unit at a time.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.llm import units as U
from newsloom.llm.words import Words, find_words, mix, slices, span_hashes, word_hashes
from newsloom.scratch import materialize, scratch_path

WINDOW = 20
#: A run of WINDOW words holds a block that begins at a multiple of BLOCK if 2 * BLOCK - 1 <= WINDOW.
BLOCK = 10
#: Bits of a block's hash beside those of its bucket. More hits than there are only cost time.
BLOCK_BITS = 29
UNIT_BYTES = 2 << 20
#: Text in a bucket of the stored table, which holds some units, and the fewest and most buckets.
STORED_BYTES = 16 << 20
LEAST_STORED, MOST_STORED = 64, 50_000

NO_ID = np.int64(2**63 - 1)
PROBE, RUN, HIT_BLOCKS, FIRST_RUNS = 0, 1, 2, 3
MESSAGE = "kind int, bucket int, unit int, keys binary, extra binary, ids binary"
MESSAGE_SCHEMA = pa.schema(
    [("kind", pa.int32()), ("bucket", pa.int32()), ("unit", pa.int32())]
    + [(c, pa.binary()) for c in ("keys", "extra", "ids")]
)


@dataclass
class Unit:
    """Word hashes of a unit's documents in a row; document i has words ``first[i]`` to ``first[i + 1]``."""

    hashes: np.ndarray
    first: np.ndarray
    ids: np.ndarray

    @property
    def doc(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.ids)), np.diff(self.first))

    def windows(self, size: int) -> np.ndarray:
        """First words of all runs of ``size`` words that lie in one document."""
        doc = self.doc
        begins = np.arange(max(0, len(doc) - size + 1))
        return begins[doc[begins] == doc[begins + size - 1]] if len(begins) else begins

    def blocks(self) -> np.ndarray:
        """Whether a reference block begins at each word."""
        at = np.arange(len(self.hashes)) - self.first[:-1][self.doc] if len(self.hashes) else np.zeros(0, np.int64)
        return at % BLOCK == 0


def whole_words(table: pa.Table) -> Iterator[tuple[pa.RecordBatch, Words]]:
    for rows in slices(iter(table.to_batches()), "text"):
        yield rows, find_words(rows.column("text"))


def read_unit(table: pa.Table) -> Unit:
    hashes, counts, ids = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for rows, words in whole_words(table):
        hashes.append(word_hashes(words))
        counts.append(words.count)
        ids.append(rows.column("doc_id").cast(pa.int64()).fill_null(NO_ID).to_numpy(zero_copy_only=False))
    first = np.concatenate([[0], np.cumsum(np.concatenate(counts))])
    return Unit(np.concatenate(hashes), first, np.concatenate(ids))


def run_hashes(unit: Unit, begins: np.ndarray, size: int, lane: int = 0) -> np.ndarray:
    return span_hashes(mix(unit.hashes, 31 + lane), begins, begins + size, 0xD1B54A32D192ED03 + 2 * lane)


def ordered_ids(ids: np.ndarray) -> np.ndarray:
    """Ids as unsigned numbers in the same order."""
    return ids.view(np.uint64) ^ np.uint64(1 << 63)


# --- first exchange: blocks and probes ----------------------------------------


def probe_messages(unit: Unit, number: int, buckets: int) -> Iterator[tuple]:
    """Distinct rolling windows with two flags: a block of this unit, several times in it."""
    begins = unit.windows(BLOCK)
    keys = block_keys(run_hashes(unit, begins, BLOCK), buckets)
    distinct, place, times = np.unique(keys, return_inverse=True, return_counts=True)
    block = np.zeros(len(distinct), bool)
    block[place[unit.blocks()[begins]]] = True
    flags = block.astype(np.uint64) + np.uint64(2) * (times > 1).astype(np.uint64)
    order, rest, at = U.by_bucket(distinct, buckets)
    flags = flags[order]
    for b in np.flatnonzero(np.diff(at)).tolist():
        part = slice(at[b], at[b + 1])
        yield PROBE, b, number, U.pack_sorted(rest[part]), U.pack_numbers(flags[part]), b""


def block_keys(hashes: np.ndarray, buckets: int) -> np.ndarray:
    return hashes & np.uint64((1 << (BLOCK_BITS + buckets.bit_length() - 1)) - 1)


def answer_probes(table: pa.Table) -> Iterator[tuple]:
    """For each unit those of its blocks that a probe from another place hits."""
    bucket = int(table.column("bucket")[0].as_py())
    rest = [U.unpack_sorted(x) for x in U.binary(table.column("keys"))]
    flags = [U.unpack_numbers(x) for x in U.binary(table.column("extra"))]
    keys, places = U.summed(rest, [1 + (f >> np.uint64(1)) for f in flags])
    for unit, own, f in zip(table.column("unit").to_pylist(), rest, flags, strict=True):
        blocks = own[(f & np.uint64(1)) > 0]
        hit = blocks[places[np.searchsorted(keys, blocks)] > 1]
        if len(hit):
            yield HIT_BLOCKS, bucket, unit, U.pack_sorted(hit), b"", b""


# --- second exchange: runs around hit blocks -----------------------------------


def extended_runs(unit: Unit, hit: np.ndarray, buckets: int) -> np.ndarray:
    """First words of the runs whose own block is among the hit ones."""
    begins = unit.windows(WINDOW)
    if not len(begins) or not len(hit):
        return begins[:0]
    blocks = np.flatnonzero(unit.blocks())
    doc = unit.doc
    blocks = blocks[blocks + BLOCK <= unit.first[1:][doc[blocks]]]
    found = np.isin(block_keys(run_hashes(unit, blocks, BLOCK), buckets), hit)
    at_hit = np.zeros(len(unit.hashes) + WINDOW, bool)
    at_hit[blocks[found]] = True
    within = begins - unit.first[:-1][doc[begins]]
    return begins[at_hit[begins + -within % BLOCK]]


@dataclass
class Runs:
    """Candidate runs of a unit: distinct ones by bucket, and which of them each place holds."""

    begins: np.ndarray
    keys: np.ndarray
    checks: np.ndarray
    place: np.ndarray
    least_id: np.ndarray
    order: np.ndarray
    rest: np.ndarray
    at: np.ndarray


def distinct_runs(unit: Unit, hit: np.ndarray, buckets: int) -> Runs:
    begins = extended_runs(unit, hit, buckets)
    keys = run_hashes(unit, begins, WINDOW)
    checks = run_hashes(unit, begins, WINDOW, 1) & np.uint64(0xFFFF)
    by_key = np.lexsort((checks, keys))
    new = np.ones(len(keys), bool)
    k, c = keys[by_key], checks[by_key]
    new[1:] = (k[1:] != k[:-1]) | (c[1:] != c[:-1])
    place = np.empty(len(keys), np.int64)
    place[by_key] = np.cumsum(new) - 1
    heads = np.flatnonzero(new)
    ids = ordered_ids(unit.ids)[unit.doc[begins]] if len(begins) else np.zeros(0, np.uint64)
    least = np.minimum.reduceat(ids[by_key], heads) if len(heads) else ids
    keys, checks = k[new], c[new]
    bits = np.uint64(buckets.bit_length() - 1)
    bucket = (keys & np.uint64(buckets - 1)).astype(np.int64)
    order = np.lexsort((checks, keys, bucket))
    at = np.searchsorted(bucket[order], np.arange(buckets + 1))
    return Runs(begins, keys, checks, place, least, order, keys[order] >> bits, at)


def run_messages(unit: Unit, number: int, hit: np.ndarray, buckets: int) -> Iterator[tuple]:
    """Distinct candidate runs with 16 more bits of hash and the smallest id that holds each."""
    runs = distinct_runs(unit, hit, buckets)
    checks, least = runs.checks[runs.order], runs.least_id[runs.order]
    for b in np.flatnonzero(np.diff(runs.at)).tolist():
        part = slice(runs.at[b], runs.at[b + 1])
        yield RUN, b, number, U.pack_sorted(runs.rest[part]), U.pack_numbers(checks[part]), U.pack_numbers(least[part])


def answer_runs(table: pa.Table) -> Iterator[tuple]:
    """For each message a bit for each run, in its order: set if no smaller id holds it elsewhere."""
    bucket = int(table.column("bucket")[0].as_py())
    rest = [U.unpack_sorted(x) for x in U.binary(table.column("keys"))]
    checks = [U.unpack_numbers(x) for x in U.binary(table.column("extra"))]
    ids = [U.unpack_numbers(x) for x in U.binary(table.column("ids"))]
    k, c, i = (np.concatenate(x) for x in (rest, checks, ids))
    order = np.lexsort((c, k))
    new = np.ones(len(k), bool)
    new[1:] = (k[order][1:] != k[order][:-1]) | (c[order][1:] != c[order][:-1])
    least = np.minimum.reduceat(i[order], np.flatnonzero(new))
    first = np.empty(len(k), bool)
    first[order] = i[order] == least[np.cumsum(new) - 1]
    ends = np.cumsum([len(x) for x in rest])
    for unit, end, x in zip(table.column("unit").to_pylist(), ends.tolist(), rest, strict=True):
        yield FIRST_RUNS, bucket, unit, b"", np.packbits(first[end - len(x) : end]).tobytes(), b""


# --- removal -------------------------------------------------------------------


def hit_blocks(answers: pa.Table, buckets: int) -> np.ndarray:
    kinds = answers.column("kind").to_numpy()
    parts = [np.zeros(0, np.uint64)]
    for i in np.flatnonzero(kinds == HIT_BLOCKS).tolist():
        bucket = answers.column("bucket")[i].as_py()
        parts.append(U.whole_keys(U.unpack_sorted(answers.column("keys")[i].as_py()), bucket, buckets))
    return np.concatenate(parts)


def repeated_runs(unit: Unit, answers: pa.Table, buckets: int) -> np.ndarray:
    """First words of the runs that also occur earlier."""
    runs = distinct_runs(unit, hit_blocks(answers, buckets), buckets)
    first_here = np.zeros(len(runs.keys), bool)
    kinds = answers.column("kind").to_numpy()
    for i in np.flatnonzero(kinds == FIRST_RUNS).tolist():
        bucket = answers.column("bucket")[i].as_py()
        part = runs.order[runs.at[bucket] : runs.at[bucket + 1]]
        bits = np.frombuffer(answers.column("extra")[i].as_py(), np.uint8)
        first_here[part] = np.unpackbits(bits, count=len(part)).astype(bool)
    # Of the places in this unit the earliest one stays, if the run is first here; rows that share
    # id and start with it are not after it.
    ids, starts = places_of(unit, runs.begins)
    order = np.lexsort((starts, ids, runs.place))
    head = np.ones(len(order), bool)
    head[1:] = runs.place[order][1:] != runs.place[order][:-1]
    head_of = order[np.flatnonzero(head)][np.cumsum(head) - 1] if len(order) else order
    same = (ids[order] == ids[head_of]) & (starts[order] == starts[head_of])
    stays = np.zeros(len(order), bool)
    stays[order] = same & first_here[runs.place[order]]
    return runs.begins[~stays]


def places_of(unit: Unit, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    doc = unit.doc[begins] if len(begins) else np.zeros(0, np.int64)
    return ordered_ids(unit.ids)[doc], begins - unit.first[:-1][doc]


def covered(begins: np.ndarray, size: int, n: int) -> np.ndarray:
    """Which of n words lie in a run that begins at one of ``begins``."""
    steps = np.zeros(n + 1, np.int64)
    np.add.at(steps, begins, 1)
    np.add.at(steps, begins + size, -1)
    return np.cumsum(steps[:-1]) > 0


def kept_text(words: Words, gone: np.ndarray) -> pa.Array:
    """Texts of the words that stay, joined by single spaces."""
    text = words.text_of_word()
    kept = np.flatnonzero(~gone)
    last = np.ones(len(kept), bool)
    last[:-1] = text[kept][1:] != text[kept][:-1]
    steps = np.zeros(len(words.data) + 2, np.int64)
    steps[words.starts[kept]] += 1
    # A word that isn't the last to stay is followed by a separator, which becomes the space.
    np.add.at(steps, words.ends[kept] + ~last, -1)
    data = words.data.copy()
    data[words.ends[kept][~last]] = 0x20
    inside = np.cumsum(steps[: len(data)]) > 0
    size = np.concatenate([[0], np.cumsum(inside)])[words.text_at]
    raw = data[inside].tobytes()
    out = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(words.text_at) - 1, [None, pa.py_buffer(size.astype(np.int64)), pa.py_buffer(raw)]
    )
    return out.cast(pa.large_string()).cast(pa.string())


def spans_of(gone: np.ndarray, first: np.ndarray) -> pa.Array:
    """[(start, end)] of the runs of removed words of each document, in words."""
    border = np.zeros(len(gone) + 1, bool)
    border[first] = True
    begin = gone & (border[:-1] | ~np.concatenate([[False], gone[:-1]]))
    end = gone & (border[1:] | ~np.concatenate([gone[1:], [False]]))
    starts, stops = np.flatnonzero(begin), np.flatnonzero(end) + 1
    places = np.searchsorted(starts, first)
    base = np.repeat(first[:-1], np.diff(places))
    pairs = pa.StructArray.from_arrays([pa.array(starts - base), pa.array(stops - base)], ["start", "end"])
    return pa.ListArray.from_arrays(pa.array(places, pa.int32()), pairs)


def bucketed(docs: DataFrame, units: int, size: int) -> DataFrame:
    """(unit, doc_id, text) as a table in buckets of whole units; ``size`` is that of all texts."""
    spark = docs.sparkSession
    buckets = min(MOST_STORED, max(LEAST_STORED, -(-size // STORED_BYTES)))
    name = f"newsloom_units_{uuid.uuid4().hex}"
    rows = docs.select(U.unit_of(F.col("doc_id"), units).alias("unit"), F.col("doc_id").cast("long").alias("doc_id"), "text")
    writer = rows.repartition(buckets, "unit").write.bucketBy(buckets, "unit").option("compression", "zstd")
    writer.option("path", scratch_path(spark, "units")).format("parquet").saveAsTable(name)
    table = spark.table(name)
    spark.sql(f"DROP TABLE {name}")  # the files stay
    return table


def repeated_passages(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, n_removed, spans, kept) for every row of ``docs`` (doc_id, text).

    A word goes if it lies in a run of ``WINDOW`` words that also starts earlier: in
    a row with a smaller doc_id, or with the same doc_id at an earlier word. Words are
    what lies between blanks, tabs and line ends; ``spans`` are the removed stretches,
    ``kept`` the other words joined by single spaces. Null texts have no words. Rows
    without doc_id come after all others; rows that repeat a doc_id count as one
    document, in which a run of one row may start earlier in another. Other columns
    are not read.
    """
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    units = max(U.LEAST, -(-size // UNIT_BYTES))
    _, buckets = U.plan_sizes(docs)
    texts = bucketed(docs, units, size)

    def probe(key: tuple, table: pa.Table) -> pa.Table:
        return U.rows_to_table(probe_messages(read_unit(table), key[0].as_py(), buckets), MESSAGE_SCHEMA)

    def to_probes(table: pa.Table) -> pa.Table:
        return U.rows_to_table(answer_probes(table), MESSAGE_SCHEMA)

    def extend(key: tuple, table: pa.Table, answers: pa.Table) -> pa.Table:
        if not table.num_rows or not answers.num_rows:
            return MESSAGE_SCHEMA.empty_table()
        unit = read_unit(table)
        return U.rows_to_table(run_messages(unit, key[0].as_py(), hit_blocks(answers, buckets), buckets), MESSAGE_SCHEMA)

    def to_runs(table: pa.Table) -> pa.Table:
        return U.rows_to_table(answer_runs(table), MESSAGE_SCHEMA)

    def remove(key: tuple, table: pa.Table, answers: pa.Table) -> pa.Table:
        unit = read_unit(table)
        gone = covered(repeated_runs(unit, answers, buckets), WINDOW, len(unit.hashes))
        parts, doc = [], 0
        for rows, words in whole_words(table):
            first = unit.first[doc : doc + rows.num_rows + 1]
            own = gone[first[0] : first[-1]]
            removed = np.add.reduceat(np.concatenate([own, [False]]).astype(np.int64), words.first[:-1]) * (words.count > 0)
            columns = [
                rows.column("doc_id"),
                pa.array(words.count, pa.int64()),
                pa.array(removed, pa.int64()),
                spans_of(own, words.first),
                kept_text(words, own),
            ]
            parts.append(pa.Table.from_arrays(columns, ["doc_id", "n_words", "n_removed", "spans", "kept"]))
            doc += rows.num_rows
        return pa.concat_tables(parts)

    asked = texts.groupBy("unit").applyInArrow(probe, MESSAGE)
    hits = materialize(asked.groupBy("bucket").applyInArrow(to_probes, MESSAGE), "hit-blocks")
    extended = texts.groupBy("unit").cogroup(hits.groupBy("unit")).applyInArrow(extend, MESSAGE)
    firsts = materialize(extended.groupBy("bucket").applyInArrow(to_runs, MESSAGE), "first-runs")
    answers = hits.unionByName(firsts)
    result = "doc_id long, n_words long, n_removed long, spans array<struct<start: long, end: long>>, kept string"
    return texts.groupBy("unit").cogroup(answers.groupBy("unit")).applyInArrow(remove, result)
