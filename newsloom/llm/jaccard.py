"""Similarity join on word n-grams: exact Jaccard, candidates by MinHash with Bayesian pruning.

Texts with the same words are one class; only class representatives are compared.
MinHash bands deal them into buckets, and a pair is looked at in the first band it
shares. There its MinHash values are compared a few at a time, and the pair is
dropped as soon as the posterior probability that its similarity reaches the
threshold falls below a tolerance. The rest is verified on the n-grams themselves.

A bucket may hold any number of texts. It is cut into chunks, pairs of chunks are
tiles of bounded size, and a tile reports sums and a spanning forest of its links,
so neither rows nor memory grow with the pairs in a bucket.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.llm.components import components
from newsloom.llm.words import BLANK, find_words, give_back, mix, slices, span_hashes, window_hashes, word_hashes
from newsloom.scratch import materialize

SHINGLE_WORDS = 5
THRESHOLD = 0.8
#: MinHash values of 16 bits; the four values of a band make one 64-bit number. A pair at the
#: threshold shares no band with probability (1 - 0.8**4)**24 = 3e-6.
BANDS, BAND_VALUES = 24, 4
HASHES = BANDS * BAND_VALUES
#: Values compared before each look at the posterior, and the probability below which a pair is dropped.
STEPS = (16, 32, 48, 64, 80, 96)
TOLERANCE = 1e-6
#: Texts and n-grams that a chunk of a bucket holds on average.
CHUNK = 512
CHUNK_NGRAMS = 1 << 19
#: Rows of tiles and n-grams of their texts for each task beyond the number that the session sets.
TASK_ROWS = 50_000
TASK_NGRAMS = 1 << 23
#: Bytes of rows of tiles, and of the texts that are cut into n-grams, that are held at once.
GROUP_BYTES = 8 << 20
TEXT_BYTES = 1 << 18
#: Pairs and n-gram columns that are held at once.
PAIRS_AT_ONCE = 50_000
COLUMNS_AT_ONCE = 1 << 15


# --- sketches ----------------------------------------------------------------


@cache
def _multipliers() -> tuple[np.ndarray, np.ndarray]:
    numbers = mix(np.arange(1, 2 * HASHES + 1, dtype=np.uint64), 11)
    return (numbers[:HASHES] >> np.uint64(32)).astype(np.uint32) | np.uint32(1), (numbers[HASHES:] >> np.uint64(32)).astype(np.uint32)


def shingles(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """n-gram hashes of all texts in a row, where each text begins (n + 1 places), and class hashes (n, 2).

    A text of fewer words than an n-gram has is one n-gram; a text without words has none.
    """
    words = find_words(texts, BLANK, lower=True)
    hashes, count = word_hashes(words), words.count
    values, begins = window_hashes(words, hashes, SHINGLE_WORDS)
    short = np.flatnonzero((count > 0) & (count < SHINGLE_WORDS))
    extra = span_hashes(mix(hashes, 7), words.first[short], words.first[short + 1])
    per_text = np.where(count >= SHINGLE_WORDS, count - SHINGLE_WORDS + 1, (count > 0).astype(np.int64))
    first = np.concatenate([[0], np.cumsum(per_text)])
    out = np.empty(first[-1], np.uint64)
    single = np.zeros(first[-1], bool)
    single[first[short]] = True
    out[single], out[~single] = extra, values
    spans = words.first[:-1], words.first[1:]
    classes = np.stack([span_hashes(mix(hashes, 21 + k), *spans, (0x9E3779B97F4A7C15 + 2 * k) | 1) for k in (0, 1)], axis=1)
    return out, first, classes


def signatures(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """(texts, HASHES) MinHash values of 16 bits; 0 throughout for texts without n-grams."""
    out = np.zeros((len(first) - 1, HASHES), np.uint16)
    some = np.flatnonzero(np.diff(first) > 0)
    if not len(some):
        return out
    short = (mix(values, 3) >> np.uint64(32)).astype(np.uint32)
    with np.errstate(over="ignore"):
        for k, (a, b) in enumerate(zip(*_multipliers(), strict=True)):
            least = np.minimum.reduceat(short * a + b, first[some])
            out[some, k] = (least * np.uint32(0x85EBCA6B)) >> np.uint32(16)
    return out


def sketches(docs: DataFrame) -> DataFrame:
    """(doc_id, key, node, n, sig): hash, class, number of n-grams, and band values of every row."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in slices(batches, "text", TEXT_BYTES):
            values, first, classes = shingles(rows.column("text"))
            bands = signatures(values, first).view(np.int64)
            places = pa.array(np.arange(0, len(bands) * BANDS + 1, BANDS), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    rows.column("doc_id"),
                    rows.column("key"),
                    nodes(classes),
                    pa.array(np.diff(first), pa.int64()),
                    pa.ListArray.from_arrays(places, pa.array(bands.ravel())),
                ],
                ["doc_id", "key", "node", "n", "sig"],
            )

    rows = docs.select("doc_id", row_key().alias("key"), "text")
    return rows.mapInArrow(work, f"doc_id {kind}, key long, node binary, n long, sig array<long>")


def row_key() -> Column:
    """Names a row of ``docs`` among those of its doc_id: the same for rows of the same text, up to hash collisions."""
    return F.xxhash64("doc_id", "text")


def nodes(classes: np.ndarray) -> pa.Array:
    """Class hashes as 16 bytes each."""
    raw = classes.astype(">u8").tobytes()
    return pa.array([raw[i : i + 16] for i in range(0, len(raw), 16)], pa.binary())


# --- candidate pairs in a tile -----------------------------------------------


@cache
def least_matches(threshold: float) -> dict[int, int]:
    """For each step the fewest equal values of a pair that goes on.

    With a uniform prior, m equal values of n leave P(similarity >= t) =
    P(Binomial(n + 1, t) <= m).
    """
    out = {}
    for n in STEPS:
        below, m = 0.0, -1
        while below < TOLERANCE:
            m += 1
            below += math.comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
        out[n] = m
    return out


def all_pairs(group: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places (a, b), a < b, of all pairs in a sorted column of groups, some at a time."""
    n = len(group)
    end = np.searchsorted(group, group, "right")
    partners = end - np.arange(n) - 1
    total = np.concatenate([[0], np.cumsum(partners)])
    at = 0
    while at < n:
        stop = max(at + 1, int(np.searchsorted(total, total[at] + PAIRS_AT_ONCE, "right")) - 1)
        a = np.repeat(np.arange(at, stop), partners[at:stop])
        b = np.arange(len(a)) - np.repeat(total[at:stop] - total[at], partners[at:stop]) + a + 1
        yield a, b
        at = stop


def candidate_pairs(
    group: np.ndarray, band: np.ndarray, sides: np.ndarray, whole: np.ndarray, sig: np.ndarray, threshold: float
) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of a group that share no earlier band, come from both sides (unless ``whole``), and survive pruning."""
    values = sig.view(np.uint16).reshape(len(sig), HASHES)
    least = least_matches(threshold)
    left, right = [], []
    for a, b in all_pairs(group):
        ok = whole[a] | (sides[a] != sides[b])
        a, b = a[ok], b[ok]
        earlier = (sig[a] == sig[b]) & (np.arange(BANDS) < band[a][:, None])
        home = ~earlier.any(axis=1)
        a, b = a[home], b[home]
        seen, equal = 0, np.zeros(len(a), np.int64)
        for n in STEPS:
            equal += (values[a, seen:n] == values[b, seen:n]).sum(axis=1)
            alive = equal >= least[n]
            a, b, equal, seen = a[alive], b[alive], equal[alive], n
        left.append(a)
        right.append(b)
    return np.concatenate([*left, np.zeros(0, np.int64)]), np.concatenate([*right, np.zeros(0, np.int64)])


# --- sorted partitions, group by group ---------------------------------------


def whole_groups(batches: Iterator[pa.RecordBatch], keys: list[str], max_rows: int) -> Iterator[pa.Table]:
    """Tables of whole groups from rows sorted by ``keys``; about ``max_rows`` rows or ``GROUP_BYTES``, one group at least."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if batch.num_rows:
            held.append(batch)
        if sum(b.num_rows for b in held) < max_rows and sum(b.nbytes for b in held) < GROUP_BYTES:
            continue
        table = pa.Table.from_batches(held)
        group = group_numbers(table, keys)
        last = int(np.searchsorted(group, group[-1]))
        if last:
            yield table.slice(0, last)
            held = table.slice(last).combine_chunks().to_batches()
    if held:
        yield pa.Table.from_batches(held)
    give_back()


def group_numbers(table: pa.Table, keys: list[str]) -> np.ndarray:
    """0, 1, 2, ... for the runs of equal keys."""
    new = np.zeros(table.num_rows, bool)
    for k in keys:
        values = table.column(k).to_numpy()
        new[1:] |= values[1:] != values[:-1]
    return np.cumsum(new)


TILE = ["bucket", "band", "low", "high"]


def sig_matrix(table: pa.Table) -> np.ndarray:
    column = table.column("sig").combine_chunks()
    flat = column.flatten() if isinstance(column, pa.Array) else pa.concat_arrays(c.flatten() for c in column.chunks)
    return np.asarray(flat, np.int64).reshape(table.num_rows, BANDS)


def tile_pairs(table: pa.Table, threshold: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    group = group_numbers(table, TILE)
    number = lambda c: table.column(c).to_numpy()
    whole = number("low") == number("high")
    return group, *candidate_pairs(group, number("band"), number("chunk"), whole, sig_matrix(table), threshold)


def surviving_members(threshold: float) -> Callable:
    """Rows of tiles that have a candidate pair."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, TILE, 8_000):
            _, a, b = tile_pairs(table, threshold)
            keep = np.zeros(table.num_rows, bool)
            keep[a] = keep[b] = True
            yield from table.filter(pa.array(keep)).to_batches()

    return work


def common_counts(values: np.ndarray, first: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many distinct values the texts a[i] and b[i] have in common, by bit rows over blocks of values."""
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))
    distinct, column = np.unique(values, return_inverse=True)
    out = np.zeros(len(a), np.int64)
    order = np.argsort(column, kind="stable")
    column, text = column[order], text[order]
    for low in range(0, len(distinct), COLUMNS_AT_ONCE):
        part = slice(*np.searchsorted(column, [low, low + COLUMNS_AT_ONCE]))
        width = min(COLUMNS_AT_ONCE, len(distinct) - low)
        bits = np.zeros((len(first) - 1, -(-width // 64) * 64), bool)
        bits[text[part], column[part] - low] = True
        packed = np.packbits(bits, axis=1).view(np.uint64)
        for at in range(0, len(a), max(1, (1 << 22) // packed.shape[1])):
            some = slice(at, at + max(1, (1 << 22) // packed.shape[1]))
            out[some] += np.bitwise_count(packed[a[some]] & packed[b[some]]).sum(axis=1, dtype=np.int64)
    return out


def spanning_links(a: np.ndarray, b: np.ndarray) -> list[tuple[int, int]]:
    """Links that connect what all pairs (a, b) connect, each node with the smallest of its component."""
    root: dict[int, int] = {}

    def find(x: int) -> int:
        while root.setdefault(x, x) != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for x, y in zip(a.tolist(), b.tolist(), strict=True):
        x, y = find(x), find(y)
        if x != y:
            root[max(x, y)] = min(x, y)
    return [(x, find(x)) for x in root if find(x) != x]


LINKS = "node binary, links long, other binary"


def shingle_sets(texts: pa.Array) -> tuple[list[np.ndarray], np.ndarray]:
    """The distinct n-gram hashes of each text, and class hashes, cut from some of the texts at a time."""
    sets, classes = [], []
    for rows in slices(iter([pa.RecordBatch.from_arrays([texts], ["text"])]), "text", TEXT_BYTES):
        values, first, named = shingles(rows.column("text"))
        sets += [np.unique(values[a:b]) for a, b in zip(first[:-1], first[1:], strict=True)]
        classes.append(named)
    return sets, np.concatenate(classes)


def verified_links(threshold: float) -> Callable:
    """From tiles with texts: (node, links) sums and (node, other) spanning links."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, TILE, 500):
            # One row of a class stands for it; rows of another text under the same id are not of the class.
            sets, classes = shingle_sets(table.column("text").combine_chunks())
            table = table.drop_columns(["text"])
            own = np.array(nodes(classes).to_pylist(), object)
            node = np.array(table.column("node").to_pylist(), object)
            keep = own == node
            seen = set()
            for i, key in enumerate(zip(group_numbers(table, TILE).tolist(), node.tolist(), strict=True)):
                keep[i] &= key not in seen
                if keep[i]:
                    seen.add(key)
            rows = np.flatnonzero(keep)
            group, a, b = tile_pairs(table.take(pa.array(rows)), threshold)
            text, size = rows, table.column("size").to_numpy()
            out: list[tuple] = []
            for g in np.unique(group[a]).tolist():
                mine = slice(*np.searchsorted(group, [g, g + 1]))
                members = text[mine]
                here = slice(*np.searchsorted(group[a], [g, g + 1]))
                x, y = a[here] - mine.start, b[here] - mine.start
                parts = [sets[t] for t in members]
                sizes = np.array([len(p) for p in parts])
                begins = np.concatenate([[0], np.cumsum(sizes)])
                common = common_counts(np.concatenate(parts), begins, x, y)
                # Compared as whole numbers: common / union >= threshold.
                linked = common >= np.ceil(threshold * (sizes[x] + sizes[y] - common) - 1e-9)
                x, y = x[linked], y[linked]
                links = np.bincount(x, size[members[y]], len(members)) + np.bincount(y, size[members[x]], len(members))
                out += [(node[members[i]], int(links[i]), None) for i in np.flatnonzero(links)]
                out += [(node[members[i]], 0, node[members[j]]) for i, j in spanning_links(x, y)]
            if out:
                columns = list(zip(*out, strict=True))
                types = (pa.binary(), pa.int64(), pa.binary())
                arrays = [pa.array(c, t) for c, t in zip(columns, types, strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, ["node", "links", "other"])

    return work


# --- the join ----------------------------------------------------------------


def dealt(rows: DataFrame, tasks: int) -> DataFrame:
    """Rows sorted by tile, each tile in one task."""
    tasks = max(tasks, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return rows.repartition(tasks, *TILE).sortWithinPartitions(*TILE)


def tiles_of(members: DataFrame) -> DataFrame:
    """(bucket, band, low, high, chunk, node): every member of a shared bucket in its tiles."""
    banded = members.select("node", "n", F.posexplode("sig").alias("band", "value"))
    banded = banded.select("node", "n", "band", F.xxhash64("band", "value").alias("bucket"))
    sizes = banded.groupBy("bucket", "band").agg(F.count("*").alias("texts"), F.sum("n").alias("ngrams")).filter("texts > 1")
    chunks = F.least("texts", F.greatest(F.ceil(F.col("texts") / CHUNK), F.ceil(F.col("ngrams") / CHUNK_NGRAMS)))
    sizes = materialize(sizes.select("bucket", "band", chunks.cast("int").alias("chunks")), "buckets")
    shared = banded.join(sizes, ["bucket", "band"])
    chunk = F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int")
    each = shared.withColumn("chunk", chunk).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    return each.select(
        "bucket", "band", F.least("chunk", "other").alias("low"), F.greatest("chunk", "other").alias("high"), "chunk", "node"
    )


def similar_documents(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, class_id, n_links, group_id and ``row_key`` for every row of ``docs`` (doc_id, text).

    ``class_id`` is the smallest doc_id of the rows with the same words (ASCII case
    and white space aside), ``n_links`` the number of other rows with a Jaccard
    similarity of word 5-grams of at least ``threshold``, copies included, and
    ``group_id`` the smallest doc_id that links lead to. Texts of fewer words are one
    n-gram; null texts and texts without words are copies of each other and like no
    other. Rows that repeat a doc_id are judged one by one. Ids are null where all
    rows of a class or group have none. Other columns are not read.
    """
    drawn = materialize(sketches(docs), "sketches")
    classes = drawn.groupBy("node").agg(
        F.min("doc_id").alias("class_id"), F.count("*").alias("size"), F.any_value("n").alias("n"), F.any_value("sig").alias("sig")
    )
    classes = materialize(classes, "classes")
    members = classes.filter("n > 0").select("node", "n", "sig")
    tiles = materialize(tiles_of(members), "tiles")
    looked = dealt(tiles.join(members.drop("n"), "node"), -(-tiles.count() // TASK_ROWS))
    schema = looked.schema
    survivors = looked.mapInArrow(surviving_members(threshold), schema).select(*TILE, "chunk", "node")
    survivors = materialize(survivors, "survivors")
    by_class = survivors.groupBy("node").agg(F.collect_list(F.struct(*TILE, "chunk")).alias("tiles"))
    wanted = materialize(by_class.join(classes, "node").select("class_id", "node", "size", "n", "sig", "tiles"), "wanted")
    texts = docs.select(F.col("doc_id"), "text").join(wanted, F.col("doc_id").eqNullSafe(F.col("class_id")))
    each = texts.select("node", "size", "sig", "text", F.explode("tiles").alias("t")).select("t.*", "node", "size", "sig", "text")
    ngrams = wanted.agg(F.sum(F.col("n") * F.size("tiles"))).first()[0] or 0
    links = materialize(dealt(each, -(-ngrams // TASK_NGRAMS)).mapInArrow(verified_links(threshold), LINKS), "links")
    counted = links.groupBy("node").agg(F.sum("links").alias("links"))
    roots = components(links.filter("other IS NOT NULL").select(F.col("node").alias("u"), F.col("other").alias("v")))
    named = classes.select("node", "class_id", "size").join(counted, "node", "left").join(roots, "node", "left")
    named = materialize(named.withColumn("root", F.coalesce("root", "node")), "named")
    groups = named.groupBy("root").agg(F.min("class_id").alias("group_id"))
    result = named.join(materialize(groups, "groups"), "root").select(
        "node", "class_id", (F.col("size") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), "group_id"
    )
    return drawn.select("doc_id", "key", "node").join(materialize(result, "class-links"), "node").select(
        "doc_id", "class_id", "n_links", "group_id", "key"
    )


def keep_one_of_each_group(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` with the smallest doc_id of their group, with all their columns.

    Rows that repeat that doc_id and text stay together, as do rows of a group in which none has an id.
    """
    judged = similar_documents(docs, threshold)
    gone = judged.filter(~F.col("doc_id").eqNullSafe(F.col("group_id")))
    gone = materialize(gone.select(F.col("doc_id").alias("gone_id"), F.col("key").alias("gone_key")).distinct(), "near-copies")
    same = docs["doc_id"].eqNullSafe(gone["gone_id"]) & (row_key() == gone["gone_key"])
    return docs.join(gone, same, "left_anti")
