"""Hard negatives by bounds along a spanning tree of the anchors.

Scores are inner products of whole numbers. The anchors of a group of bounded size
form a minimum spanning tree. From the score of a candidate at an anchor follow bounds
at the next one on the tree: an edge of length d moves a score by at most d times the
candidate's norm. A candidate is scored anew only where its bounds overlap the window
that matters: scores up to the fifth best of the anchor's label, and afterwards the
windows that the positives set for negatives. A new score tightens the bounds for all
anchors further down.

Candidates lie in stored blocks. A group of anchors is sent to all tasks, each walks
the tree for its blocks and keeps the best few of every anchor, and these meet in small
aggregations. No pair of rows is stored unless it is among the best of a task.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from newsloom.scratch import materialize

POSITIVES = 5
NEGATIVES = 5
#: A negative scores at least this share of its positive, in hundredths.
LEAST_SHARE = 80
#: Components are multiplied by this and rounded down.
SCALE = 256
#: Bytes of the vectors of a stored block of candidates; bytes of the vectors of a group of anchors, and anchors in it.
BLOCK_BYTES = 2 << 20
GROUP_BYTES = 1 << 20
GROUP_ANCHORS = 2048
#: Share of a block beyond which all of it is scored, which costs less than picking rows.
WHOLE_SHARE = 0.25
#: Scores are exact in double precision below this.
EXACT = 2.0**53


def usable(label: Column, vector: Column) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return label.isNotNull() & vector.isNotNull() & F.coalesce(finite, F.lit(False))


def scaled(column: pa.Array, dimension: int) -> np.ndarray:
    """Rows of whole numbers, as doubles."""
    flat = np.asarray(column.flatten(), np.float64)
    return np.floor(SCALE * flat).reshape(len(column), dimension)


def candidate_blocks(rows: DataFrame, dimension: int) -> DataFrame:
    """(block, ids, labels, vectors): rows (id, label, vector) of one length in blocks of bounded size."""
    per = max(64, BLOCK_BYTES // (8 * max(1, dimension)))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, per):
                part = batch.slice(at, per)
                x = scaled(part.column("vector"), dimension)
                ids = part.column("id").to_numpy(zero_copy_only=False).astype("<i8")
                labels = part.column("label").to_numpy(zero_copy_only=False).astype("<i8")
                columns = [[ids.tobytes()], [labels.tobytes()], [x.astype("<f8").tobytes()]]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.binary()) for c in columns], ["ids", "labels", "vectors"])

    blocks = rows.select("id", "label", "vector").mapInArrow(work, "ids binary, labels binary, vectors binary")
    # Names of blocks: one counter a partition, taken when the blocks are stored.
    return materialize(blocks.withColumn("block", F.monotonically_increasing_id()), "candidate-blocks")


@dataclass
class Block:
    name: int
    ids: np.ndarray
    labels: np.ndarray
    x: np.ndarray
    norms: np.ndarray


def read_blocks(batches: Iterator[pa.RecordBatch], dimension: int) -> Iterator[Block]:
    for batch in batches:
        for at in range(batch.num_rows):
            raw = {c: batch.column(c)[at].as_py() for c in batch.schema.names}
            ids = np.frombuffer(raw["ids"], "<i8")
            x = np.frombuffer(raw["vectors"], "<f8").reshape(len(ids), dimension)
            norms = np.sqrt((x * x).sum(axis=1)) * (1 + 1e-12)
            yield Block(raw["block"], ids, np.frombuffer(raw["labels"], "<i8"), x, norms)


# --- anchors ------------------------------------------------------------------


@dataclass
class Anchors:
    """A group of anchors in the order of a walk down their spanning tree; ``parent`` -1 is the root."""

    block: np.ndarray
    row: np.ndarray
    ids: np.ndarray
    labels: np.ndarray
    x: np.ndarray
    parent: np.ndarray
    edge: np.ndarray
    #: Where the children of each end: bounds of an anchor are let go after its last child.
    last_child: np.ndarray


def spanning_tree(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(order, parent, edge): a minimum spanning tree by Euclidean distance, parents before children.

    ``parent`` holds places in ``order``.
    """
    n = len(x)
    near, link = np.full(n, np.inf), np.zeros(n, np.int64)
    open_ = np.ones(n, bool)
    at, parent_of, edge_of = 0, np.full(n, -1, np.int64), np.zeros(n)
    for _ in range(n - 1):
        open_[at] = False
        gap = x - x[at]
        distance = np.sqrt(np.einsum("ij,ij->i", gap, gap))
        closer = open_ & (distance < near)
        near[closer], link[closer] = distance[closer], at
        at = int(np.argmin(np.where(open_, near, np.inf)))
        parent_of[at], edge_of[at] = link[at], near[at]
    children: list[list[int]] = [[] for _ in range(n)]
    for v in range(n):
        if parent_of[v] >= 0:
            children[parent_of[v]].append(v)
    order, stack = [], [0] if n else []
    while stack:
        v = stack.pop()
        order.append(v)
        stack += children[v]
    place = np.empty(n, np.int64)
    place[order] = np.arange(n)
    order = np.array(order, np.int64)
    parent = np.array([place[parent_of[v]] if parent_of[v] >= 0 else -1 for v in order], np.int64)
    return order, parent, edge_of[order] * (1 + 1e-12)


def anchor_group(rows: list, dimension: int) -> Anchors:
    x = np.array([np.frombuffer(r.vector, "<f8") for r in rows]).reshape(len(rows), dimension)
    order, parent, edge = spanning_tree(x)
    pick = lambda values: np.array(values, np.int64)[order]
    last = np.full(len(rows), -1, np.int64)
    for child, p in enumerate(parent):
        if p >= 0:
            last[p] = child
    return Anchors(
        pick([r.block for r in rows]), pick([r.row for r in rows]), pick([r.id for r in rows]), pick([r.label for r in rows]),
        x[order], parent, edge, last,
    )


def find_anchors(blocks: DataFrame, dimension: int, every: int, groups: int) -> DataFrame:
    """(block, row, id, label, vector, part): the anchors by where they lie, dealt to groups."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in read_blocks(batches, dimension):
            at = np.flatnonzero(block.ids % every == 0)
            vectors = [block.x[i].tobytes() for i in at]
            columns = [pa.array(np.full(len(at), block.name)), pa.array(at), pa.array(block.ids[at]), pa.array(block.labels[at])]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(vectors, pa.binary())], ["block", "row", "id", "label", "vector"])

    found = blocks.mapInArrow(work, "block long, row long, id long, label long, vector binary")
    return found.withColumn("part", F.pmod(F.xxhash64("block", "row"), F.lit(groups)).cast("int"))


class Walk:
    """Bounds of the scores of a block's candidates, anchor after anchor down the tree."""

    def __init__(self, anchors: Anchors, block: Block):
        self.anchors, self.block = anchors, block
        self.held: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        self.scored = 0

    def bounds(self, a: int) -> tuple[np.ndarray, np.ndarray]:
        p = self.anchors.parent[a]
        if p < 0:
            scores = self.score(a, slice(None))
            found = scores, scores.copy()
        else:
            low, high = self.held[p]
            if self.anchors.last_child[p] == a:
                del self.held[p]
            moved = self.anchors.edge[a] * self.block.norms
            # Room for rounding: scores are whole numbers.
            found = low - moved - 0.25, high + moved + 0.25
        if self.anchors.last_child[a] >= 0:
            self.held[a] = found
        return found

    def score(self, a: int, rows) -> np.ndarray:
        scores = self.block.x[rows] @ self.anchors.x[a]
        self.scored += len(scores)
        return scores

    def exact(self, a: int, low: np.ndarray, high: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Candidates among ``wanted`` (a mask) and their scores; bounds are tightened by them."""
        if wanted.sum() > WHOLE_SHARE * len(wanted):
            low[:] = high[:] = self.score(a, slice(None))
            rows = np.flatnonzero(wanted)
        else:
            rows = np.flatnonzero(wanted)
            low[rows] = high[rows] = self.score(a, rows)
        return rows, low[rows]


class Best:
    """The first few (score descending, id, block, row) of a running selection."""

    def __init__(self, size: int):
        self.size = size
        self.rows = np.zeros((0, 4))
        self.least = -np.inf

    def add(self, scores: np.ndarray, ids: np.ndarray, block: int, rows: np.ndarray) -> None:
        keep = scores >= self.least
        if not keep.any():
            return
        new = np.zeros(int(keep.sum()), RANKED)
        new["score"], new["id"], new["block"], new["row"] = scores[keep], ids[keep], block, rows[keep]
        every = np.concatenate([self.rows, new]) if len(self.rows) else new
        order = np.lexsort((every["row"], every["block"], every["id"], -every["score"]))[: self.size]
        self.rows = every[order]
        if len(self.rows) == self.size:
            self.least = float(self.rows["score"][-1])


RANKED = np.dtype([("score", "<i8"), ("id", "<i8"), ("block", "<i8"), ("row", "<i8")])
FOUND = "anchor int, positive int, score long, id long, block long, row long"


def found_rows(found: Iterator[tuple[int, int, np.ndarray]]) -> Iterator[pa.RecordBatch]:
    for anchor, positive, rows in found:
        n = len(rows)
        if n:
            columns = [pa.array(np.full(n, anchor, np.int32)), pa.array(np.full(n, positive, np.int32))]
            columns += [pa.array(np.ascontiguousarray(rows[c])) for c in ("score", "id", "block", "row")]
            yield pa.RecordBatch.from_arrays(columns, ["anchor", "positive", "score", "id", "block", "row"])


def best_of_label(blocks: DataFrame, anchors, dimension: int) -> DataFrame:
    """The first positives of each anchor in each task."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group: Anchors = anchors.value
        best = [Best(POSITIVES) for _ in group.ids]
        for block in read_blocks(batches, dimension):
            walk = Walk(group, block)
            for a in range(len(group.ids)):
                low, high = walk.bounds(a)
                wanted = (block.labels == group.labels[a]) & (high >= best[a].least)
                if group.block[a] == block.name:
                    wanted[group.row[a]] = False
                rows, scores = walk.exact(a, low, high, wanted)
                best[a].add(scores, block.ids[rows], block.name, rows)
        yield from found_rows((a, 0, b.rows) for a, b in enumerate(best))

    return first_of_each(blocks.mapInArrow(work, FOUND), ["anchor"], POSITIVES)


def best_in_windows(blocks: DataFrame, anchors, positives, dimension: int) -> DataFrame:
    """The first negatives of each anchor and positive in each task; ``positives``: scores by anchor."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group: Anchors = anchors.value
        windows = {a: np.array(scores) for a, scores in positives.value.items()}
        best = {a: [Best(NEGATIVES) for _ in scores] for a, scores in windows.items()}
        for block in read_blocks(batches, dimension):
            walk = Walk(group, block)
            for a in range(len(group.ids)):
                low, high = walk.bounds(a)
                if a not in windows:
                    continue
                tops = windows[a]
                # The least that still counts for any positive: its window's end, or what its negatives have reached.
                floors = [max(-(-LEAST_SHARE * int(t) // 100), b.least) for t, b in zip(tops, best[a], strict=True)]
                wanted = (block.labels != group.labels[a]) & (high >= min(floors)) & (low <= tops.max())
                rows, scores = walk.exact(a, low, high, wanted)
                for top, kept in zip(tops.tolist(), best[a], strict=True):
                    inside = (100 * scores >= LEAST_SHARE * top) & (scores <= top)
                    kept.add(scores[inside], block.ids[rows[inside]], block.name, rows[inside])
        yield from found_rows((a, k, b.rows) for a, each in best.items() for k, b in enumerate(each))

    return first_of_each(blocks.mapInArrow(work, FOUND), ["anchor", "positive"], NEGATIVES)


def first_of_each(rows: DataFrame, keys: list[str], n: int) -> DataFrame:
    """The first ``n`` rows of each key by score, then id, numbered ``rank``."""
    order = [F.desc("score"), "id", "block", "row"]
    ranked = rows.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.filter(F.col("rank") <= n)


# --- the table ----------------------------------------------------------------


RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def hard_negatives(
    table: DataFrame, every: int = 100, id_column: str = "vec_id", label: str = "label", vector: str = "embedding"
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Anchors are the rows whose whole-number id is divisible by ``every``. Scores are
    inner products of the components times 256, rounded down; higher ones come first,
    then smaller ids. An anchor's positives are the first 5 other rows of its label;
    each gets the first 5 rows of other labels that score between 80 % of its score
    and all of it. A positive without such a row, or with a score below 0, has none.

    Rows without a label or vector, or with a null or non-finite component, take no
    part, nor do rows without id, which have no place in the order. Rows that repeat
    an id are rows of their own. Vectors are compared with vectors of the same length;
    rows with components so large that scores would leave the whole numbers that
    doubles hold (about 3,200 at 64 dimensions) take no part. An empty table gives an
    empty one. Other columns are not read.
    """
    spark = table.sparkSession
    rows = table.select(F.col(id_column).cast("long").alias("id"), F.col(label).cast("long").alias("label"), F.col(vector).alias("vector"))
    rows = rows.filter(F.col("id").isNotNull() & usable(F.col("label"), F.col("vector")))
    room = F.sqrt(F.lit(EXACT / 200) / F.greatest(F.size("vector"), F.lit(1))) / SCALE
    rows = rows.filter(F.coalesce(F.array_max(F.transform("vector", lambda x: F.abs(x))).cast("double"), F.lit(0.0)) < room - 1)
    lengths = [r.d for r in rows.select(F.size("vector").alias("d")).distinct().collect()]
    out = spark.createDataFrame([], RESULT)
    for dimension in sorted(lengths):
        of_length = rows.filter(F.size("vector") == dimension)
        blocks = candidate_blocks(of_length, dimension)
        anchors = of_length.filter(F.col("id") % every == 0).count()
        groups = max(1, -(-anchors // GROUP_ANCHORS), -(-anchors * 8 * dimension // GROUP_BYTES))
        found = materialize(find_anchors(blocks, dimension, every, groups), "anchors")
        for part in range(groups):
            out = out.unionByName(negatives_of_group(blocks, found.filter(F.col("part") == part), dimension))
    return out


def negatives_of_group(blocks: DataFrame, chosen: DataFrame, dimension: int) -> DataFrame:
    """The result for one group of anchors: a group is ``GROUP_BYTES`` of vectors on average."""
    spark = blocks.sparkSession
    group = anchor_group(chosen.collect(), dimension)
    anchors = spark.sparkContext.broadcast(group)
    positives = materialize(best_of_label(blocks, anchors, dimension).select("anchor", "rank", "score", "id"), "positives")
    scores: dict[int, list[int]] = {}
    for r in positives.select("anchor", "rank", "score").orderBy("anchor", "rank").collect():
        scores.setdefault(r.anchor, []).append(r.score)
    found = materialize(best_in_windows(blocks, anchors, spark.sparkContext.broadcast(scores), dimension), "negatives")
    named = spark.createDataFrame([(i, int(v)) for i, v in enumerate(group.ids)], "anchor int, anchor_id long")
    of = positives.select("anchor", (F.col("rank") - 1).alias("positive"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    joined = found.withColumnsRenamed({"id": "negative_id", "score": "negative_score"}).join(F.broadcast(of), ["anchor", "positive"])
    return joined.join(F.broadcast(named), "anchor").select([c.split()[0] for c in RESULT.split(", ")])


def shifted_labels(table: DataFrame, every: int = 7, labels: int = 10) -> DataFrame:
    """``table`` with the label of rows whose vec_id is divisible by ``every`` moved on by one."""
    moved = F.when(F.col("vec_id") % every == 0, (F.col("label") + 1) % labels).otherwise(F.col("label"))
    return table.withColumn("label", moved)
