"""Document fingerprints from prefix polynomial hashes.

The prefix array of a text holds, for every position, the polynomial hash of all code
points before it modulo a prime. The hash of any span follows from two entries, so two
spans are compared in constant time, and the longest common extension of two positions
is found by binary search over its length.

A fingerprint is a thinned prefix array: the entries at fixed positions, whose
distances grow with the position, and at a few anchors, which the words around them
choose, so that the same passage has the same anchors wherever it lies. Any span
between two entries can still be compared. Two fingerprints are alike by the spans
between entries that both have: a common beginning is located by binary search over
the fixed entries, and the spans between common anchors are compared one by one.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.llm.words import mix, slices

#: Hashes are taken modulo this prime, with two bases.
PRIME = (1 << 31) - 1
BASES = (1_103_515_245, 1_664_525_013)
#: Code points in the window that decides whether a position is an anchor, and anchors of a text.
WINDOW = 12
ANCHORS = 24
#: Fixed positions: each about 1.4 times the one before it.
GRID = np.unique(np.floor(2.0 ** (np.arange(1, 63) / 2)).astype(np.int64))
#: Positions that are worked on at once, UTF-8 bytes of the texts that are, and of a partition.
BLOCK = 1 << 16
TEXT_BYTES = 1 << 18
PARTITION_BYTES = 16 << 20


# --- prefix arrays ------------------------------------------------------------


@cache
def _power_tables(base: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**(BLOCK * i) for i < BLOCK."""
    tables = []
    for step in (base, pow(base, BLOCK, PRIME)):
        out = np.ones(1, np.uint64)
        while len(out) < BLOCK:
            out = np.concatenate([out, out * np.uint64(pow(step, len(out), PRIME)) % PRIME])
        tables.append(out)
    return tables[0], tables[1]


def power(base: int, exponents: np.ndarray) -> np.ndarray:
    """base**e modulo the prime; e below 2**32."""
    low, high = _power_tables(base)
    e = exponents.astype(np.int64)
    return low[e % BLOCK] * high[e // BLOCK] % PRIME


def prefix_sums(codes: np.ndarray, base: int) -> np.ndarray:
    """n + 1 numbers: the sum of (code + 1) * base**i over the codes before each position."""
    out = np.zeros(len(codes) + 1, np.uint32)
    up, carry = _power_tables(base)[0], 0
    for at in range(0, len(codes), BLOCK):
        part = codes[at : at + BLOCK].astype(np.uint64) + np.uint64(1)
        sums = np.cumsum(part * up[: len(part)] % PRIME) % PRIME
        block = (sums * np.uint64(pow(base, at, PRIME)) + np.uint64(carry)) % PRIME
        out[at + 1 : at + 1 + len(part)] = block
        carry = int(block[-1])
    return out


def difference(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a.astype(np.uint64) + np.uint64(PRIME) - b.astype(np.uint64)) % PRIME


class PrefixHashes:
    """Prefix arrays of several texts in a row; text i lies at ``first[i]`` to ``first[i + 1]``."""

    def __init__(self, texts: list[str]):
        self.codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
        self.first = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
        self.sums = [prefix_sums(self.codes, base) for base in BASES]

    @property
    def count(self) -> np.ndarray:
        return np.diff(self.first)

    def spans(self, starts: np.ndarray, ends: np.ndarray, k: int) -> np.ndarray:
        """Hash by base k of each span of places in the row, wherever it lies."""
        moved = difference(self.sums[k][ends], self.sums[k][starts])
        return moved * power(pow(BASES[k], -1, PRIME), starts) % PRIME

    def prefixes(self, text: np.ndarray, positions: np.ndarray) -> np.ndarray:
        """Hashes by both bases, in one number, of the first ``positions`` code points of the texts."""
        starts = self.first[text]
        one, two = (self.spans(starts, starts + positions, k) for k in (0, 1))
        return one << np.uint64(31) | two

    def equal(self, a: np.ndarray, b: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Whether the spans of ``length`` from places a and b are equal, up to hash collisions."""
        same = np.ones(len(a), bool)
        for k in (0, 1):
            same &= self.spans(a, a + length, k) == self.spans(b, b + length, k)
        return same

    def common_extension(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The length of the longest equal spans that begin at places a and b and stay in their texts."""
        end = lambda x: self.first[np.searchsorted(self.first, x, "right").clip(max=len(self.first) - 1)]
        low, high = np.zeros(len(a), np.int64), np.minimum(end(a) - a, end(b) - b)
        while (low < high).any():
            middle = (low + high + 1) // 2
            same = self.equal(a, b, middle)
            low, high = np.where(same, middle, low), np.where(same, high, middle - 1)
        return low


# --- fingerprints -------------------------------------------------------------


@dataclass
class Fingerprints:
    """Of n texts: length, whole hash, (n, GRID) hashes, and (n, ANCHORS) places (-1: none), marks and hashes."""

    length: np.ndarray
    whole: np.ndarray
    grid: np.ndarray
    place: np.ndarray
    mark: np.ndarray
    anchor: np.ndarray

    def take(self, rows) -> Fingerprints:
        return Fingerprints(*(getattr(self, f)[rows] for f in self.__dataclass_fields__))

    def strings(self) -> list[str]:
        """Each as text: all its numbers, little-endian, in base 64."""
        out = []
        for i in range(len(self.length)):
            n, found = self.length[i], int((self.place[i] >= 0).sum())
            head = np.array([n, self.whole[i]], np.uint64)
            wide = np.concatenate([head, self.grid[i, GRID < n], self.anchor[i, :found], self.place[i, :found].astype(np.uint64)])
            raw = wide.astype("<u8").tobytes() + self.mark[i, :found].astype("<u4").tobytes()
            out.append(base64.b64encode(raw).decode("ascii"))
        return out


def parse(texts: list[str]) -> Fingerprints:
    """Fingerprints from their ``strings``."""
    out = blank(len(texts))
    for i, text in enumerate(texts):
        raw = base64.b64decode(text)
        n = int.from_bytes(raw[:8], "little")
        fixed = int((GRID < n).sum())
        found = (len(raw) - 16 - 8 * fixed) // 20
        wide = np.frombuffer(raw[: 16 + 8 * fixed + 16 * found], "<u8")
        out.length[i], out.whole[i] = n, wide[1]
        out.grid[i, :fixed] = wide[2 : 2 + fixed]
        out.anchor[i, :found] = wide[2 + fixed : 2 + fixed + found]
        out.place[i, :found] = wide[2 + fixed + found :]
        out.mark[i, :found] = np.frombuffer(raw[len(wide) * 8 :], "<u4")
    return out


def blank(n: int) -> Fingerprints:
    u64 = lambda *shape: np.zeros(shape, np.uint64)
    return Fingerprints(
        np.zeros(n, np.int64), u64(n), u64(n, len(GRID)), np.full((n, ANCHORS), -1, np.int64), u64(n, ANCHORS), u64(n, ANCHORS)
    )


def marked_positions(row: PrefixHashes, limits: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, position, mark) of the windows whose mark is below the limit of their text."""
    text_of, at, marks = [], [], []
    last = row.first[1:] - WINDOW
    for begin in range(0, len(row.codes), BLOCK):
        places = np.arange(begin, min(begin + BLOCK, len(row.codes)))
        text = np.searchsorted(row.first, places, "right") - 1
        inside = (places <= last[text]) & (limits[text] > 0)
        places, text = places[inside], text[inside]
        mark = mix(row.spans(places, places + WINDOW, 0), 12) >> np.uint64(32)
        low = mark < limits[text]
        text_of.append(text[low])
        at.append(places[low] - row.first[text[low]])
        marks.append(mark[low])
    join = lambda parts, kind: np.concatenate([*parts, np.zeros(0, kind)]).astype(kind)
    return join(text_of, np.int64), join(at, np.int64), join(marks, np.uint64)


def fingerprints(row: PrefixHashes) -> Fingerprints:
    """Of every text: its prefix hashes at the fixed positions and at the first places of its smallest marks."""
    out = blank(len(row.count))
    out.length[:] = row.count
    each = np.arange(len(row.count))
    out.whole[:] = row.prefixes(each, row.count)
    text, k = np.nonzero(GRID[None, :] < row.count[:, None])
    out.grid[text, k] = row.prefixes(text, GRID[k])
    # About four times as many windows as are wanted lie below the first limit; a text that repeats itself is searched whole.
    windows = np.maximum(row.count - WINDOW + 1, 0)
    limits = np.where(windows > 0, np.minimum(2.0**32, 4 * ANCHORS * 2.0**32 / np.maximum(windows, 1)), 0).astype(np.uint64)
    while limits.any():
        text, at, mark = marked_positions(row, limits)
        order = np.lexsort((at, mark, text))
        text, at, mark = text[order], at[order], mark[order]
        new = np.ones(len(text), bool)
        new[1:] = (text[1:] != text[:-1]) | (mark[1:] != mark[:-1])
        text, at, mark = text[new], at[new], mark[new]
        rank = np.arange(len(text)) - np.searchsorted(text, text)
        wanted = rank < ANCHORS
        out.place[text[wanted], rank[wanted]] = at[wanted]
        out.mark[text[wanted], rank[wanted]] = mark[wanted]
        short = (np.bincount(text, minlength=len(limits)) < ANCHORS) & (limits > 0) & (limits < np.uint64(1 << 32))
        limits = np.where(short, np.uint64(1 << 32), np.uint64(0))
    text, k = np.nonzero(out.place >= 0)
    out.anchor[text, k] = row.prefixes(text, out.place[text, k])
    return out


def common_beginning(a: Fingerprints, b: Fingerprints) -> tuple[np.ndarray, np.ndarray]:
    """The last fixed position (0: none) up to which each pair of texts agrees, by binary search, and the hash there."""
    fixed = np.searchsorted(GRID, np.minimum(a.length, b.length), "left")
    rows = np.arange(len(fixed))
    low, high = np.zeros(len(fixed), np.int64), fixed.copy()
    while (low < high).any():
        middle = (low + high + 1) // 2
        place = np.maximum(middle - 1, 0)
        same = (middle == 0) | (a.grid[rows, place] == b.grid[rows, place])
        low, high = np.where(same, middle, low), np.where(same, high, middle - 1)
    place = np.maximum(low - 1, 0)
    return np.where(low > 0, GRID[place], 0), np.where(low > 0, a.grid[rows, place], 0).astype(np.uint64)


def likeness(a: Fingerprints, b: Fingerprints) -> np.ndarray:
    """For each pair the code points in spans that both fingerprints show to be equal, as a share of both lengths.

    1 for equal texts (two empty ones too), 0 where no entry is common.
    """
    n = len(a.length)
    met = (a.mark[:, :, None] == b.mark[:, None, :]) & (a.place >= 0)[:, :, None] & (b.place >= 0)[:, None, :]
    partner, found = met.argmax(axis=2), met.any(axis=2)
    begin, hashed = common_beginning(a, b)
    zero = np.zeros((n, 1), np.int64)
    # Entries that may be common: the beginning, the last fixed one, the anchors, and the end.
    p = np.concatenate([zero, begin[:, None], a.place, a.length[:, None]], axis=1)
    q = np.concatenate([zero, begin[:, None], np.take_along_axis(b.place, partner, 1), b.length[:, None]], axis=1)
    none = zero.astype(np.uint64)
    hp = np.concatenate([none, hashed[:, None], a.anchor, a.whole[:, None]], axis=1)
    hq = np.concatenate([none, hashed[:, None], np.take_along_axis(b.anchor, partner, 1), b.whole[:, None]], axis=1)
    valid = np.concatenate([zero == 0, zero == 0, found, zero == 0], axis=1)
    far = np.int64(1) << 40
    order = np.argsort(np.where(valid, p, far), axis=1, kind="stable")
    p, q, hp, hq, valid = (np.take_along_axis(x, order, 1) for x in (p, q, hp, hq, valid))
    length = p[:, 1:] - p[:, :-1]
    same = valid[:, 1:] & valid[:, :-1] & (length > 0) & (length == q[:, 1:] - q[:, :-1])
    low = np.uint64((1 << 31) - 1)
    for k, part in enumerate((lambda h: h >> np.uint64(31), lambda h: h & low)):
        of_a = difference(part(hp)[:, 1:], part(hp)[:, :-1]) * power(BASES[k], q[:, :-1].clip(min=0)) % PRIME
        of_b = difference(part(hq)[:, 1:], part(hq)[:, :-1]) * power(BASES[k], p[:, :-1].clip(min=0)) % PRIME
        same &= of_a == of_b
    covered = np.where(same, length, 0).sum(axis=1)
    equal = (a.length == b.length) & (a.whole == b.whole)
    return np.where(equal, 1.0, np.minimum(1.0, 2 * covered / np.maximum(a.length + b.length, 1)))


# --- the table ----------------------------------------------------------------


def texts_of(column: pa.Array) -> list[str]:
    return [(x or b"").decode("utf-8", "replace") for x in column.cast(pa.binary()).to_pylist()]


def edited_text(text: str, following: str) -> str:
    """The last quarter of ``text`` replaced by the beginning of ``following``."""
    cut = len(text) // 4
    return text[: len(text) - cut] + following[:cut]


OUTPUT = "n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def judged(ids: pa.Array, texts: list[str], following: list[str]) -> pa.RecordBatch:
    edited = [edited_text(t, f) for t, f in zip(texts, following, strict=True)]
    own = fingerprints(PrefixHashes(texts))
    # The texts that follow are the texts themselves, one further on, wherever both lie in a row.
    if following[:-1] == texts[1:]:
        last = fingerprints(PrefixHashes(following[-1:]))
        after = Fingerprints(*(np.concatenate([getattr(own, f)[1:], getattr(last, f)]) for f in own.__dataclass_fields__))
    else:
        after = fingerprints(PrefixHashes(following))
    changed = fingerprints(PrefixHashes(edited))
    columns = [
        ids,
        pa.array(own.length),
        pa.array([hashlib.sha256(t.encode("utf-8", "replace")).hexdigest() for t in edited]),
        pa.array(own.strings()),
        pa.array(changed.strings()),
        pa.array(likeness(own, changed)),
        pa.array(likeness(own, after)),
    ]
    return pa.RecordBatch.from_arrays(columns, ["doc_id", *[c.split()[0] for c in OUTPUT.split(", ")]])


def fingerprinted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every row but the last of a sorted partition, judged with the row after it."""
    waiting: pa.RecordBatch | None = None
    for piece in slices(batches, "text", TEXT_BYTES):
        piece = piece.select(["doc_id", "text"])
        rows = piece if waiting is None else pa.concat_batches([waiting, piece])
        waiting = rows.slice(rows.num_rows - 1)
        if rows.num_rows > 1:
            texts = texts_of(rows.column("text"))
            yield judged(rows.column("doc_id").slice(0, len(texts) - 1), texts[:-1], texts[1:])


def outermost(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(slot, last, first): the last row of a sorted partition, to meet the first text of the partition after it."""
    part, first, last = TaskContext.get().partitionId(), None, None
    for batch in batches:
        if batch.num_rows:
            first = batch.slice(0, 1) if first is None else first
            last = batch.slice(batch.num_rows - 1)
    if first is None:
        return
    row = lambda b: {"doc_id": b.column("doc_id")[0].as_py(), "text": b.column("text")[0].as_py() or ""}
    kind = pa.struct([("doc_id", first.schema.field("doc_id").type), ("text", pa.string())])
    columns = [pa.array([part + 1, part]), pa.array([row(last), None], kind), pa.array([None, row(first)], kind)]
    yield pa.RecordBatch.from_arrays(columns, ["slot", "last", "first"])


def judged_edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(batch.num_rows):
            row = batch.slice(at, 1)
            yield judged(row.column("doc_id"), texts_of(row.column("text")), texts_of(row.column("after")))


def fingerprint_documents(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next for every row of
    ``docs`` (doc_id, text).

    The edited text has its last quarter replaced by the beginning of the text of the
    next row in the order of doc_id (after the last row comes the first); ``near_``
    columns tell how alike the fingerprint is to that of the edited text and of the
    next text. Null texts are empty; empty texts are like each other only. Rows
    without doc_id come first, rows that repeat a doc_id follow each other in the
    order of a hash of their texts. An empty table gives an empty one; the row of a
    table of one is its own next. Texts may be of any length below 2**31 code
    points: a task holds some 30 bytes for each of the longest. Other columns are
    not read.

    The texts are sorted by range once, and a task judges its rows against the ones
    after them; the last row of a range meets the first text of the next one in a
    small aggregation over the same shuffle.
    """
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("tie", F.xxhash64("text"))
    parts = max(1, -(-size // PARTITION_BYTES), int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    placed = rows.repartitionByRange(parts, "doc_id", "tie").sortWithinPartitions("doc_id", "tie", "text")
    inner = placed.mapInArrow(fingerprinted, f"doc_id {kind}, {OUTPUT}")

    row = f"struct<doc_id: {kind}, text: string>"
    edges = placed.mapInArrow(outermost, f"slot long, last {row}, first {row}")
    met = edges.groupBy("slot").agg(F.max("last").alias("last"), F.max("first").alias("first"))
    # The first row of all and the last one have no neighbour in their slots: they meet each other.
    around = F.when(F.col("last").isNull() | F.col("first").isNull(), -1).otherwise(F.col("slot"))
    met = met.groupBy(around.alias("slot")).agg(F.max("last").alias("last"), F.max("first").alias("first"))
    closing = met.select("last.doc_id", "last.text", F.col("first.text").alias("after"))
    return inner.unionByName(closing.mapInArrow(judged_edges, f"doc_id {kind}, {OUTPUT}"))
