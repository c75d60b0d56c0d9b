"""Packing of token pieces into sequences: a configuration linear program over lengths.

A configuration says how many pieces of each length share a sequence. The program
asks for the fewest sequences whose configurations cover the histogram of lengths.
Multiplicative weights solve it: lengths that are still uncovered keep their
weight, covered ones lose it, and the configuration of most weight is found by a
knapsack dynamic program over the sequence length. Its rounding packs whole
numbers of each configuration; what is left is solved again and at last packed
best fit, the longest first. All of this sees the histogram only, which has no
more entries than a sequence has tokens. Spark tokenises, counts lengths, ranks
the pieces of a length and looks their places up.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cache
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.llm.ranks import with_rank
from newsloom.llm.words import give_back, slices
from newsloom.scratch import materialize

SEQUENCE_TOKENS = 4096
END_ID = 1
#: Rounds of weights for one linear program, and the step by which a covered length loses weight.
ROUNDS = 96
STEP = 0.5
#: Lengths weigh a little more than their tokens, so that short pieces are left for where they are needed.
PRIOR = 1.1
#: Pieces up to which configurations hold no more of a length than there are, and their rounds.
FEW, FEW_ROUNDS = 2000, 24
#: Share of a sequence that a configuration fills to be used once more than its rounded number.
FULL = 0.999
#: A character of no language, which is put between words that are encoded together.
SEPARATOR = "\ue000"
#: Words that go to the tokenizer in one call; its own results take many times the room of the ids.
WORDS_AT_ONCE = 2048
#: Bytes of text that a worker codes at once: its arrays take some forty times as much.
CODED_BYTES = 1 << 20
#: Words whose ids a worker remembers.
REMEMBERED_WORDS = 600_000


# --- the plan: histogram to configurations -----------------------------------


def best_configuration(value: np.ndarray, capacity: int) -> np.ndarray:
    """The multiset of lengths of most value that fits: how many pieces of each length (unbounded knapsack).

    ``value[l]`` is the worth of a piece of length l, 0 if there is none.
    """
    best, worth = np.zeros(capacity + 1), np.empty(capacity)
    choice = np.zeros(capacity + 1, np.int64)
    value = np.ascontiguousarray(value, float)
    for room in range(1, capacity + 1):
        # The lengths 1 to room against what is best in the rest of the room; a length worth nothing stands for leaving it free.
        np.add(best[room - 1 :: -1], value[1 : room + 1], out=worth[:room])
        at = int(worth[:room].argmax())
        best[room], choice[room] = worth[at], at + 1
    counts = np.zeros(len(value), np.int64)
    room = capacity
    while room > 0:
        counts[choice[room]] += value[choice[room]] > 0
        room -= choice[room]
    return counts


def best_of_pieces(value: np.ndarray, need: np.ndarray, capacity: int) -> np.ndarray:
    """``best_configuration`` with no more pieces of a length than there are (knapsack piece by piece)."""
    lengths = np.flatnonzero((value > 0) & (need > 0))
    pieces = np.repeat(lengths, np.minimum(need[lengths], capacity // lengths))
    best, taken = np.zeros(capacity + 1), np.zeros((len(pieces), capacity + 1), bool)
    for i, length in enumerate(pieces.tolist()):
        worth = best[:-length] + value[length]
        np.greater(worth, best[length:], out=taken[i, length:])
        np.maximum(worth, best[length:], out=best[length:])
    counts, room = np.zeros(len(value), np.int64), capacity
    for i in range(len(pieces) - 1, -1, -1):
        if taken[i, room]:
            counts[pieces[i]] += 1
            room -= pieces[i]
    return counts


def cover(histogram: np.ndarray, capacity: int, rounds: int = ROUNDS) -> list[tuple[np.ndarray, float]]:
    """Fractional cover of the histogram by multiplicative weights: (configuration, how often)."""
    need = histogram.astype(float)
    present = need > 0
    lengths = np.arange(len(need))
    covered = np.zeros(len(need))
    found: dict[bytes, list] = {}
    for _ in range(rounds):
        # A length weighs its tokens, less and less the more of its need is covered.
        share = np.where(present, covered / np.maximum(need, 1), 0)
        weight = np.where(present, lengths**PRIOR * np.exp(-STEP * rounds * (share - share[present].min())), 0)
        weight = np.where(weight > weight.max() * 1e-9, weight, 0)
        few = need.sum() <= FEW
        counts = best_of_pieces(weight, histogram, capacity) if few else best_configuration(weight, capacity)
        used = counts > 0
        often = float((need[used] / counts[used]).min()) / rounds * 4
        covered += counts * often
        entry = found.setdefault(counts.tobytes(), [counts, 0.0])
        entry[1] += often
    scale = float(np.median((covered / np.maximum(need, 1))[present]))
    return [(c, x / max(scale, 1e-12)) for c, x in found.values()]


@dataclass
class Plan:
    """Configurations in use: (counts by length, number of sequences)."""

    capacity: int
    rows: list[tuple[dict[int, int], int]] = field(default_factory=list)

    @property
    def sequences(self) -> int:
        return sum(n for _, n in self.rows)

    def places(self) -> list[tuple[int, int, int, int, int, int]]:
        """(length, rank_from, rank_to, per_sequence, first_sequence, offset): places of the ranks of a length."""
        used: dict[int, int] = {}
        out, first = [], 0
        for counts, n in self.rows:
            offset = 0
            for length, per in sorted(counts.items(), reverse=True):
                start = used.get(length, 0)
                out.append((length, start, start + per * n, per, first, offset))
                used[length] = start + per * n
                offset += per * length
            first += n
        return out


def plan_sequences(histogram: np.ndarray, capacity: int = SEQUENCE_TOKENS) -> Plan:
    """Pack ``histogram[l]`` pieces of each length l (at most ``capacity``) into few sequences."""
    left = np.zeros(capacity + 1, np.int64)
    left[: len(histogram)] = histogram
    plan = Plan(capacity)

    def use(counts: np.ndarray, n: int) -> None:
        nonlocal left
        plan.rows.append(({int(i): int(counts[i]) for i in np.flatnonzero(counts)}, n))
        left = left - counts * n

    if left[capacity]:
        use(np.eye(1, capacity + 1, capacity, dtype=np.int64)[0], int(left[capacity]))
    lengths = np.arange(capacity + 1)
    while left.any():
        before = int(left.sum())
        found = cover(left, capacity, ROUNDS if before > FEW else FEW_ROUNDS)
        # Rounded down, the most used first; then those that leave next to nothing over once more, the longest pieces first.
        down = [(counts, int(x)) for counts, x in sorted(found, key=lambda c: -c[1])]
        full = [(counts, 1) for counts, _ in found if int(counts @ lengths) >= FULL * capacity]
        for counts, wanted in down + sorted(full, key=lambda c: -int(np.flatnonzero(c[0])[-1])):
            used = counts > 0
            n = min(wanted, int((left[used] // counts[used]).min()))
            if n > 0:
                use(counts, n)
        if int(left.sum()) > 0.9 * before:
            break
    for counts, n in best_fit(left, capacity):
        use(counts, n)
    return plan


def best_fit(histogram: np.ndarray, capacity: int) -> Iterator[tuple[np.ndarray, int]]:
    """Fill sequences one kind at a time, always by the longest piece that fits; equal fillings go together."""
    left = histogram.copy()
    while left.any():
        counts = np.zeros_like(left)
        room = capacity
        while True:
            fitting = np.flatnonzero(left[: room + 1] - counts[: room + 1] > 0)
            if not len(fitting):
                break
            length = int(fitting[-1])
            take = min(int(left[length] - counts[length]), room // length)
            counts[length] += take
            room -= take * length
        used = counts > 0
        n = int((left[used] // counts[used]).min())
        left -= counts * n
        yield counts, n


# --- tokens ------------------------------------------------------------------


@cache
def tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core, and threads keep memory
    from tokenizers import Tokenizer

    found = Tokenizer.from_file(path)
    give_back()  # what reading the file took
    return found


@cache
def special_tokens(path: str) -> tuple[str, ...]:
    """What the tokenizer takes for one token wherever it stands, in lower case."""
    return tuple(sorted({t.content.lower() for t in tokenizer(path).get_added_tokens_decoder().values()}))


def spread_out(begins: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places begin, begin + 1, ..., begin + size - 1 of every span in a row."""
    before = np.cumsum(sizes) - sizes
    return np.arange(int(sizes.sum()), dtype=np.int32) + np.repeat((begins - before).astype(np.int32), sizes)


class WordIds:
    """Ids of texts through those of their words, which are remembered up to a bound.

    The tokenizer drops white space, never joins words and breaks between a letter
    and a mark, so the ids of a text are those of its words in a row, with a space
    put between an ASCII letter and ASCII marks (but the apostrophe, which may join
    a contraction). Case is dropped for ASCII words alone: only there it can't
    change how letters compose with accents, which the tokenizer does first.
    """

    MARKS = r"([A-Za-z])([!-&(-/:-@\[-`{-~])"

    def __init__(self, path: str) -> None:
        self.path = path
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.flat, self.begin, self.size = np.zeros(0, np.uint32), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def encode(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words in a row, and how many each has.

        The words are encoded as one text with a separator between them, which is
        quicker than one by one; where the separator's ids also occur elsewhere, one by one.
        """
        encode = tokenizer(self.path).encode_batch_fast
        apart, joined = encode([SEPARATOR, f" {SEPARATOR} ".join(words)], add_special_tokens=False)
        apart, ids = np.array(apart.ids, np.uint32), np.array(joined.ids, np.uint32)
        last = max(0, len(ids) - len(apart) + 1)
        found = np.flatnonzero(np.all([ids[k : last + k] == x for k, x in enumerate(apart)], axis=0))
        if len(found) != len(words) - 1:
            coded = [c.ids for c in encode(words, add_special_tokens=False)]
            return np.array([*chain.from_iterable(coded)], np.uint32), np.array([*map(len, coded)], np.int64)
        begins = np.concatenate([[0], found + len(apart)])
        ends = np.concatenate([found, [len(ids)]])
        kept = np.ones(len(ids), bool)
        for k in range(len(apart)):
            kept[found + k] = False
        return ids[kept], ends - begins

    def places(self, words: list[str]) -> np.ndarray:
        """Where ``begin`` and ``size`` hold the ids of each of the distinct ``words``."""
        at = np.array([*map(self.known.get, words, repeat(-1))], np.int64)
        unseen = [words[i] for i in np.flatnonzero(at < 0).tolist()]
        if not unseen:
            return at
        if len(self.known) + 2 * len(unseen) > REMEMBERED_WORDS:
            self.forget()
            unseen = words
        plain = [w.lower() if w.isascii() else w for w in unseen]
        new = list(dict.fromkeys(w for w in plain if w not in self.known))
        if new:
            parts = [self.encode(new[at : at + WORDS_AT_ONCE]) for at in range(0, len(new), WORDS_AT_ONCE)]
            ids, size = (np.concatenate(x) for x in zip(*parts, strict=True))
            self.known.update(zip(new, range(len(self.size), len(self.size) + len(new)), strict=True))
            self.begin = np.concatenate([self.begin, len(self.flat) + np.cumsum(size) - size])
            self.size = np.concatenate([self.size, size])
            self.flat = np.concatenate([self.flat, ids])
        found = [self.known[w] for w in plain]
        self.known.update(zip(unseen, found, strict=True))
        if len(unseen) == len(words):
            return np.array(found, np.int64)
        at[at < 0] = found
        return at

    def of_texts(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids in a row, ``END_ID`` after each text, and where each text begins (n + 1 places).

        Texts that hold a special token of the tokenizer are given to it whole.
        """
        plain = texts.cast(pa.large_string()).fill_null("")
        whole = np.zeros(len(plain), bool)
        for token in special_tokens(self.path):
            whole |= np.asarray(pc.match_substring(plain, token, ignore_case=True))
        if not whole.any():
            return self.of_words(plain)
        ids, at = self.of_words(pc.if_else(pa.array(whole), "", plain))
        rows = np.flatnonzero(whole)
        coded = [tokenizer(self.path).encode(plain[int(i)].as_py(), add_special_tokens=False).ids for i in rows]
        size = np.zeros(len(whole) + 1, np.int64)
        size[rows + 1] = [len(c) for c in coded]
        new = np.array([*chain.from_iterable(coded)], np.uint32)
        return np.insert(ids, np.repeat(at[rows], size[rows + 1]), new), at + np.cumsum(size)

    def of_words(self, plain: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """``of_texts`` for texts without special tokens, by the ids of their words."""
        split = pc.ascii_split_whitespace(pc.replace_substring_regex(plain, self.MARKS, r"\1 \2"))
        coded = split.flatten().dictionary_encode()
        places = self.places(coded.dictionary.to_pylist())
        # The ids of the distinct words of these texts, and the end as one more word of one id.
        size = np.append(self.size[places], 1)
        own = np.cumsum(size) - size
        flat = np.append(self.flat[spread_out(self.begin[places], size[:-1])], np.uint32(END_ID))
        in_text = np.asarray(split.value_lengths(), np.int64)
        code = np.insert(np.asarray(coded.indices), np.cumsum(in_text), len(places))
        size_at = size[code]
        at = np.concatenate([[0], np.cumsum(size_at)])
        return flat[spread_out(own[code], size_at)], at[np.concatenate([[0], np.cumsum(in_text + 1)])]


@cache
def worker_words(path: str) -> WordIds:
    """One memory for all tasks of a worker."""
    return WordIds(path)


def token_pieces(
    docs: DataFrame, tokenizer_path: str, capacity: int = SEQUENCE_TOKENS, with_ids: bool = False, key: str = "doc_id"
) -> DataFrame:
    """(key, piece, start, length, ids_crc32[, ids]): the token pieces of every row of ``docs``.

    A text is its token ids and then ``END_ID``; only longer ones are cut, into
    pieces of ``capacity`` tokens and a rest. A null or empty text is the end id
    alone. Rows of the same key give pieces of their own. Other columns are not read.
    """
    kind = docs.schema[key].dataType.simpleString()
    schema = f"{key} {kind}, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = worker_words(tokenizer_path)
        for rows in slices(batches, "text", CODED_BYTES):
            ids, at = words.of_texts(rows.column("text"))
            per = -(-np.diff(at) // capacity)
            doc = np.repeat(np.arange(len(per)), per)
            piece = np.arange(len(doc)) - np.repeat(np.cumsum(per) - per, per)
            start = piece * capacity
            length = np.minimum(np.diff(at)[doc] - start, capacity)
            low = at[doc] + start
            raw = ids.astype("<u4")
            sums = [zlib.crc32(raw[a : a + n]) for a, n in zip(low.tolist(), length.tolist(), strict=True)]
            columns = [
                rows.column(key).take(pa.array(doc)),
                pa.array(piece, pa.int32()),
                pa.array(start, pa.int64()),
                pa.array(length, pa.int64()),
                pa.array(sums, pa.int64()),
            ]
            if with_ids:
                places = pa.array(np.concatenate([low, at[-1:]]), pa.int32())
                columns.append(pa.ListArray.from_arrays(places, pa.array(ids.astype(np.int32))))
            names = [c.split()[0] for c in schema.split(", ")]
            yield pa.RecordBatch.from_arrays(columns, names)

    return docs.select(key, "text").mapInArrow(work, schema)


def pack(pieces: DataFrame, capacity: int = SEQUENCE_TOKENS, key: str = "doc_id") -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to stored pieces (key, piece, start, length, ids_crc32).

    Offsets in a sequence are gapless from 0. The histogram (at most ``capacity``
    entries) goes to the driver and the places of its plan back to the tasks; they
    number a few for each length and round of weights, whatever the input.
    """
    spark = pieces.sparkSession
    counted = pieces.groupBy("length").count().collect()
    histogram = np.zeros(capacity + 1, np.int64)
    for r in counted:
        histogram[r["length"]] = r["count"]
    places = plan_sequences(histogram, capacity).places()
    names = ["length", "_from", "_to", "_per", "_first", "_offset"]
    table = spark.createDataFrame(places, ", ".join(f"{n} long" for n in names))
    order = [F.col(key), F.col("start"), F.col("ids_crc32")]
    spread = F.struct(F.col(key), F.col("start"))
    ranked = with_rank(pieces, "length", order, "_rank", spread)
    placed = ranked.join(F.broadcast(table), "length").filter("_rank >= _from AND _rank < _to")
    within = F.col("_rank") - F.col("_from")
    return placed.select(
        *[F.col(c) for c in pieces.columns],
        (F.col("_first") + F.floor(within / F.col("_per"))).cast("long").alias("sequence_id"),
        (F.col("_offset") + (within % F.col("_per")) * F.col("length")).cast("long").alias("offset"),
    )


def pack_documents(docs: DataFrame, tokenizer_path: str, capacity: int = SEQUENCE_TOKENS) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset for every piece of ``docs``."""
    pieces = materialize(token_pieces(docs, tokenizer_path, capacity), "pieces")
    return pack(pieces, capacity)
