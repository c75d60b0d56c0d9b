"""Quality classifier: regularised quadratic discriminant over document statistics.

Statistics of whole texts are transformed to be near normal, both classes get a
mean and a covariance that is shrunk towards the pooled one and its diagonal, and
a score is the posterior from the difference of the two log densities, whose
Mahalanobis terms come from Cholesky factors computed once.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.llm.words import find_words, slices, word_hashes

#: Words of one block; the worst block of a text counts beside its average.
BLOCK_WORDS = 32
#: Bytes of text whose statistics are taken at once; they need some 26 times as much memory.
PIECE_BYTES = 1 << 18

FEATURES = (
    "words",
    "word_length",
    "symbols",
    "capitals",
    "wordless",
    "marked",
    "again",
    "copies",
    "digits",
    "worst_symbols",
    "worst_capitals",
    "worst_wordless",
    "worst_marked",
    "worst_copies",
)

_CODES = np.arange(256)
_LETTER = (_CODES >= 0x80) | ((_CODES | 32) >= 97) & ((_CODES | 32) <= 122) & (_CODES >= 65)
_CAPITAL = (_CODES >= 65) & (_CODES <= 90)
_DIGIT = (_CODES >= 48) & (_CODES <= 57)
_SYMBOL = (_CODES > 32) & (_CODES < 127) & ~_LETTER & ~_DIGIT


def _per_span(flags: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    sums = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=sums[1:])
    return sums[ends] - sums[starts]


def _share(part: np.ndarray, whole: np.ndarray) -> np.ndarray:
    return part / np.maximum(whole, 1)


def document_statistics(texts: pa.Array) -> np.ndarray:
    """A row of ``FEATURES`` for each text, already transformed. Texts without words are all zeros before that."""
    words = find_words(texts)
    spans = words.starts, words.ends
    count = {
        name: _per_span(flags[words.data], *spans)
        for name, flags in (("letters", _LETTER), ("capitals", _CAPITAL), ("digits", _DIGIT), ("symbols", _SYMBOL))
    }
    count["bytes"] = words.ends - words.starts
    ascii_letters = _per_span((_LETTER & (_CODES < 0x80))[words.data], *spans)
    hashes, text = word_hashes(words), words.text_of_word()
    again = np.zeros(len(hashes), bool)
    again[1:] = (hashes[1:] == hashes[:-1]) & (text[1:] == text[:-1])
    per_word = {
        "bytes": count["bytes"],
        "letters": count["letters"],
        "ascii": ascii_letters,
        "capitals": count["capitals"],
        "digits": count["digits"],
        "symbols": count["symbols"],
        "wordless": (count["letters"] == 0) & (count["digits"] == 0),
        "marked": count["symbols"] >= 2,
        "again": again,
        "one": np.ones(len(hashes), np.int64),
    }
    # Blocks of words: whole texts hold one at least, a short rest joins the block before it.
    at = np.arange(len(hashes)) - words.first[:-1][text] if len(hashes) else np.zeros(0, np.int64)
    last = np.maximum(words.count // BLOCK_WORDS - 1, 0)
    block = np.minimum(at // BLOCK_WORDS, last[text]) if len(hashes) else at
    first_of_block = np.concatenate([[0], np.cumsum(last + 1)])
    block = block + first_of_block[text] if len(hashes) else block
    blocks = int(first_of_block[-1])
    total = {k: np.bincount(block, v, blocks) for k, v in per_word.items()}
    order = np.lexsort((hashes, block))
    copy = np.zeros(len(hashes), bool)
    copy[1:] = (hashes[order][1:] == hashes[order][:-1]) & (block[order][1:] == block[order][:-1])
    total["copies"] = np.bincount(block[order], copy, blocks)
    whole = {k: np.add.reduceat(v, first_of_block[:-1]) if blocks else v for k, v in total.items()}
    rate = {
        "symbols": ("symbols", "bytes"),
        "capitals": ("capitals", "ascii"),
        "wordless": ("wordless", "one"),
        "marked": ("marked", "one"),
        "copies": ("copies", "one"),
    }
    shares = {k: _share(total[a], total[b]) for k, (a, b) in rate.items()}
    worst = {k: np.maximum.reduceat(v, first_of_block[:-1]) if blocks else v for k, v in shares.items()}
    near_log = lambda x, least: np.log(x + least)
    columns = [
        np.log1p(words.count),
        near_log(_share(whole["letters"], whole["one"]), 0.5),
        near_log(_share(whole["symbols"], whole["bytes"]), 0.01),
        near_log(_share(whole["capitals"], whole["ascii"]), 0.02),
        near_log(_share(whole["wordless"], whole["one"]), 0.02),
        near_log(_share(whole["marked"], whole["one"]), 0.02),
        near_log(_share(whole["again"], whole["one"]), 0.02),
        np.sqrt(_share(whole["copies"], whole["one"])),
        near_log(_share(whole["digits"], whole["bytes"]), 0.01),
        near_log(worst["symbols"], 0.02),
        near_log(worst["capitals"], 0.05),
        near_log(worst["wordless"], 0.05),
        near_log(worst["marked"], 0.05),
        np.sqrt(worst["copies"]),
    ]
    return np.stack(columns, axis=1) if len(texts) else np.zeros((0, len(FEATURES)))


def statistics_of(texts: pa.Array) -> np.ndarray:
    """``document_statistics`` of a column of any size, a slice at a time."""
    batch = pa.RecordBatch.from_arrays([texts], ["text"])
    parts = [document_statistics(piece.column("text")) for piece in slices(iter([batch]), "text", PIECE_BYTES)]
    return np.concatenate(parts) if parts else np.zeros((0, len(FEATURES)))


@dataclass(frozen=True)
class Model:
    """Class sizes, means and Cholesky factors, class 0 first; ``alone`` is the score if a class has no rows."""

    sizes: tuple[float, float]
    means: np.ndarray | None = None
    factors: np.ndarray | None = None
    alone: float = 0.5

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Posterior probability of class 1 for each row of statistics."""
        if self.factors is None:
            return np.full(len(x), self.alone)
        density = []
        for size, mean, factor in zip(self.sizes, self.means, self.factors, strict=True):
            z = np.linalg.solve(factor, (x - mean).T)
            density.append(np.log(size) - np.log(np.diag(factor)).sum() - 0.5 * (z * z).sum(axis=0))
        return 1 / (1 + np.exp(np.clip(density[0] - density[1], -700, 700)))


def statistics_table(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, x): the statistics of every row; the text is read once and nothing is shuffled."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches, "text", PIECE_BYTES):
            x = document_statistics(piece.column("text"))
            lists = pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), x.shape[1]).cast(pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([piece.column(key), lists], [key, "x"])

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, "text").mapInArrow(work, f"{key} {kind}, x array<double>")


def fit(statistics: DataFrame, labels: DataFrame, shrink: float = 0.5, ridge: float = 0.2, key: str = "doc_id") -> Model:
    """Fit to all rows of ``statistics`` that have a row (key, label) with label 0 or 1.

    Sums and sums of products are aggregated by Spark; the driver gets one number
    for each pair of statistics. ``shrink`` is the weight of the pooled covariance
    in a class's own, ``ridge`` that of the pooled diagonal in the result.
    """
    width = len(FEATURES)
    label = F.col("label").cast("int")
    rows = statistics.join(labels.select(key, label.alias("label")).filter("label IN (0, 1)"), key)
    one_and_x = F.concat(F.array(F.lit(1.0)), "x")
    pairs = rows.select("label", F.posexplode(one_and_x).alias("i", "xi"), "x")
    pairs = pairs.select("label", "i", "xi", F.posexplode(F.concat(F.array(F.lit(1.0)), "x")).alias("j", "xj"))
    sums = pairs.filter("i <= j").groupBy("label", "i", "j").agg(F.sum(F.col("xi") * F.col("xj")).alias("s")).collect()
    moments = np.zeros((2, width + 1, width + 1))
    for r in sums:
        moments[r.label, r.i, r.j] = moments[r.label, r.j, r.i] = r.s
    sizes = (float(moments[0, 0, 0]), float(moments[1, 0, 0]))
    if min(sizes) == 0:
        return Model(sizes, alone=0.5 if max(sizes) == 0 else float(sizes[1] > 0))
    means = np.stack([moments[c, 0, 1:] / sizes[c] for c in (0, 1)])
    scatter = [moments[c, 1:, 1:] - sizes[c] * np.outer(means[c], means[c]) for c in (0, 1)]
    pooled = sum(scatter) / sum(sizes)
    level = np.diag(np.maximum(np.diag(pooled), 1e-6))
    own = [(1 - shrink) * s / n + shrink * pooled for s, n in zip(scatter, sizes, strict=True)]
    return Model(sizes, means, np.stack([np.linalg.cholesky((1 - ridge) * s + ridge * level) for s in own]))


def model_score(model: Model, text: Column) -> Column:
    """The score of a text column, by Arrow batches."""

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        return pa.array(model.scores(statistics_of(texts)))

    return score(F.coalesce(text, F.lit("")))


def held_out(key: Column, folds: int) -> Column:
    """Whether a row belongs to the fold that is never learned from; rows without key don't."""
    return F.coalesce(F.crc32(key.cast("string")) % folds == 0, F.lit(False))


#: A text is kept from this score on.
KEEP_SCORE = 0.3
FOLDS = 5


def learn(statistics: DataFrame, labels: DataFrame) -> Model:
    """Fit to ``labels.quality`` (doc_id, quality) of the rows outside the held-out fold."""
    known = labels.select("doc_id", F.col("quality").alias("label"))
    return fit(statistics, known.filter(~held_out(F.col("doc_id"), FOLDS)))


def score_documents(statistics: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score (0 to 1), predicted (1 from ``KEEP_SCORE`` on) for each row of ``statistics``."""

    @F.arrow_udf("double")
    def score(x: pa.Array) -> pa.Array:
        flat = np.asarray(x.flatten(), np.float64)
        return pa.array(model.scores(flat.reshape(-1, len(FEATURES))))

    scored = statistics.select("doc_id", held_out(F.col("doc_id"), FOLDS).alias("held_out"), score("x").alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= KEEP_SCORE).cast("int"))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the classifier keeps, with all their columns.

    The text is read twice (to learn, to score) instead of being shuffled to meet
    its score. Null and empty texts are scored like others; repeated rows share a
    decision. Without labels of both classes rows are kept unless all labels are 0.
    """
    model = learn(statistics_table(docs), labels)
    return docs.filter(model_score(model, F.col("text")) >= KEEP_SCORE)
