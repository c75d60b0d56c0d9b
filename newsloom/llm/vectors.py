"""Embedding near-duplicates by an epsilon grid order join.

Unit vectors of cosine >= t lie within epsilon = sqrt(2 - 2t) of each other. They
are sorted by the cells of a grid of that width over their leading principal
dimensions. The sequence is cut into intervals, and pairs of intervals are joined
from the top of a tree of bounding boxes: a pair whose boxes are further apart
than epsilon is skipped with all that is below it.

The intervals are stored once and never shuffled again. A strip of bounded size is sent
to all tasks at a time, and these read the intervals that have a partner in it. Pieces
of both are compared where their boxes are near: first by the leading principal
dimensions and the length of the rest, which no cosine exceeds, and what is left in
double precision.

A task reports sums and a spanning forest, so rows don't grow with the links. Disk
follows the vectors, not the pairs of intervals.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from newsloom.llm.components import components
from newsloom.scratch import materialize, scratch_path

COSINE = 0.9
#: Principal dimensions whose cells make the order.
GRID_DIMENSIONS = 8
#: Vectors that the principal dimensions are taken from. They set the order only: any sample gives the same links.
SAMPLE = 4096
#: Bytes of the vectors of an interval, intervals that a task sorts on average, vectors of a piece, and children of a box.
INTERVAL_BYTES = 1 << 20
SORTED = 4
PIECE = 256
FAN = 32
#: Bytes of the vectors of a strip, which every task of a round holds.
STRIP_BYTES = 32 << 20
#: Share of pairs that may pass the leading dimensions without being linked.
PASSED = 1e-4
#: Bytes of the vectors that are compared anew at once; share of two pieces' pairs beyond which all of them are.
EXACT_BYTES = 8 << 20
WHOLE_SHARE = 0.05
#: Room for rounding in box distances and before a cosine is computed anew.
SLACK = 1e-9


def usable(vector: Column, dimension: int | Column) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.coalesce((F.size(vector) == dimension) & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def unit(rows: np.ndarray) -> np.ndarray:
    """Rows as doubles of length 1."""
    scaled = rows.astype(np.float64)
    scaled = scaled / np.abs(scaled).max(axis=1, keepdims=True)
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def matrix(column: pa.Array, dimension: int) -> np.ndarray:
    return np.asarray(column.flatten()).reshape(-1, dimension)


def principal_dimensions(vectors: DataFrame, dimension: int) -> np.ndarray:
    """A rotation (columns are new dimensions), the ones of most variance first."""
    some = vectors.orderBy("node").limit(SAMPLE).collect()
    if not some:
        return np.eye(dimension)
    x = unit(np.array([r["vector"] for r in some]))
    x = x - x.mean(axis=0)
    _, turned = np.linalg.eigh(x.T @ x)
    return turned[:, ::-1].copy()


def node_names(raw: np.ndarray) -> list[bytes]:
    return [hashlib.blake2b(row.tobytes(), digest_size=16).digest() for row in np.ascontiguousarray(raw + 0.0)]  # -0.0 becomes 0.0


def usable_rows(table: DataFrame, dimension: int, id_column: str, vector: str) -> DataFrame:
    rows = table.select(F.col(id_column).alias("id"), F.col(vector).alias("vector"))
    return rows.filter(usable(F.col("vector"), dimension))


def named_rows(rows: DataFrame, dimension: int) -> DataFrame:
    """(id, node): rows with a usable vector and 16 bytes that name it."""
    kind = rows.schema["id"].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                names = node_names(matrix(batch.column("vector"), dimension))
                yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(names, pa.binary())], ["id", "node"])

    return rows.mapInArrow(work, f"id {kind}, node binary")


def counted_vectors(rows: DataFrame, dimension: int) -> DataFrame:
    """(node, size, vector): vectors and how often they occur, one row for those that a task reads together."""
    element = rows.schema["vector"].dataType.elementType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                seen: dict[bytes, int] = {}
                place = [seen.setdefault(name, len(seen)) for name in node_names(matrix(batch.column("vector"), dimension))]
                _, first, sizes = np.unique(place, return_index=True, return_counts=True)
                columns = [pa.array(list(seen), pa.binary()), pa.array(sizes, pa.int64()), batch.column("vector").take(pa.array(first))]
                yield pa.RecordBatch.from_arrays(columns, ["node", "size", "vector"])

    return rows.select("vector").mapInArrow(work, f"node binary, size long, vector array<{element}>")


# --- sequence, intervals and boxes -------------------------------------------


def number_type(element: str) -> type:
    return np.float32 if element == "float" else np.float64


def merged(names: list[np.ndarray], sizes: list[np.ndarray], rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted rows in one, those of one name with their sizes added up."""
    name, size, row = np.concatenate(names), np.concatenate(sizes), np.concatenate(rows)
    first = np.flatnonzero(np.concatenate([[True], name[1:] != name[:-1]]))
    return name[first], np.add.reduceat(size, first), row[first]


def intervals(vectors: DataFrame, turned: np.ndarray, cosine: float, count: int | None = None) -> DataFrame:
    """(part, place, box, nodes, sizes, rows): the sorted sequence in intervals of bounded size.

    Rows of ``vectors`` (node, size, vector) with one node become one. ``count`` is how
    many nodes there are, if that is known.
    """
    dimension = len(turned)
    width = np.sqrt(2 - 2 * cosine)
    kind = number_type(vectors.schema["vector"].dataType.elementType.simpleString())
    per = max(16, INTERVAL_BYTES // (np.dtype(kind).itemsize * dimension))
    leading = turned[:, :GRID_DIMENSIONS]

    @F.arrow_udf("array<int>")
    def cells(column: pa.Array) -> pa.Array:
        placed = np.floor(unit(matrix(column, dimension)) @ leading / width).astype(np.int32)
        return pa.array(list(placed), pa.list_(pa.int32()))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, place = TaskContext.get().partitionId(), 0
        names, sizes, rows = np.zeros(0, object), np.zeros(0, "<i8"), np.zeros((0, dimension), kind)

        def interval() -> pa.RecordBatch:
            at = unit(rows[:per]) @ turned
            box = np.concatenate([at.min(axis=0), at.max(axis=0)]).tolist()
            values = [[part], [place], [box], [b"".join(names[:per])], [sizes[:per].tobytes()], [rows[:per].tobytes()]]
            types = [pa.int32(), pa.int32(), pa.list_(pa.float64()), pa.binary(), pa.binary(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(values, types, strict=True)], names=COLUMNS)

        for batch in batches:
            for at in range(0, batch.num_rows, per):
                some = batch.slice(at, per)
                new = np.array(some.column("node").to_pylist(), object)
                size, row = some.column("size").to_numpy(zero_copy_only=False).astype("<i8"), matrix(some.column("vector"), dimension)
                names, sizes, rows = merged([names, new], [sizes, size], [rows, row.astype(kind)])
                # The last row is held back: more of its node may follow.
                while len(names) > per:
                    yield interval()
                    place += 1
                    names, sizes, rows = names[per:], sizes[per:], rows[per:]
        if len(names):
            yield interval()

    ordered = vectors.withColumn("cells", cells("vector"))
    order = [F.col("cells")[i] for i in range(min(GRID_DIMENSIONS, dimension))] + [F.col("node")]
    tasks = max(1, -(-(vectors.count() if count is None else count) // (SORTED * per)))
    placed = ordered.repartitionByRange(tasks, *order).sortWithinPartitions(*order).drop("cells")
    schema = "part int, place int, box array<double>, nodes binary, sizes binary, rows binary"
    return placed.mapInArrow(cut, schema)


COLUMNS = ["part", "place", "box", "nodes", "sizes", "rows"]


def box_distance(a: Column, b: Column, dimension: int) -> Column:
    """Squared distance of two boxes (lower corner, then upper corner)."""
    low = lambda x: F.slice(x, 1, dimension)
    high = lambda x: F.slice(x, dimension + 1, dimension)
    gap = lambda up, down: F.zip_with(down, up, lambda d, u: F.greatest(d - u, F.lit(0.0)))
    gaps = F.zip_with(gap(high(a), low(b)), gap(high(b), low(a)), lambda x, y: x + y)
    return F.aggregate(gaps, F.lit(0.0), lambda s, g: s + g * g)


def numbered(boxes: DataFrame) -> DataFrame:
    """(id, part, place, box) with id 0, 1, 2, ... along the sequence."""
    counts = boxes.groupBy("part").count()
    # One row for each task of the sort.
    starts = counts.withColumn("first", F.sum("count").over(Window.orderBy("part")) - F.col("count")).select("part", "first")
    return boxes.join(starts, "part").select((F.col("first") + F.col("place")).alias("id"), "part", "place", "box")


def parents(level: DataFrame, dimension: int) -> DataFrame:
    """Boxes of FAN consecutive boxes each."""
    corners = level.select(F.floor(F.col("id") / FAN).alias("id"), F.posexplode("box").alias("i", "x"))
    bounds = corners.groupBy("id", "i").agg(F.min("x").alias("low"), F.max("x").alias("high"))
    corner = F.struct("i", F.when(F.col("i") < dimension, F.col("low")).otherwise(F.col("high")).alias("x"))
    return bounds.groupBy("id").agg(F.sort_array(F.collect_list(corner)).alias("c")).select("id", F.col("c.x").alias("box"))


def near_intervals(boxes: DataFrame, dimension: int, cosine: float) -> DataFrame:
    """(a, b), a <= b: intervals whose boxes are within epsilon, found from the top of the tree."""
    levels = [materialize(boxes.select("id", "box"), "boxes")]
    while levels[-1].count() > FAN:
        levels.append(materialize(parents(levels[-1], dimension), "boxes"))
    limit = 2 - 2 * cosine + SLACK
    # At the top there are FAN boxes at most, numbered from 0.
    top = levels[-1].select(F.col("id").alias("a"))
    pairs = top.withColumn("b", F.explode(F.sequence("a", F.lit(max(levels[-1].count() - 1, 0)).cast("long"))))
    for depth, level in enumerate(reversed(levels)):
        up = F.floor(F.col("id") / FAN).cast("long") if depth else F.col("id")
        left = level.select(F.col("id").alias("a"), F.col("box").alias("box_a"), up.alias("up_a"))
        right = level.select(F.col("id").alias("b"), F.col("box").alias("box_b"), up.alias("up_b"))
        above = pairs.select(F.col("a").alias("up_a"), F.col("b").alias("up_b"))
        joined = above.join(left, "up_a").join(right, "up_b")
        close = joined.filter((F.col("a") <= F.col("b")) & (box_distance(F.col("box_a"), F.col("box_b"), dimension) <= limit))
        pairs = materialize(close.select("a", "b"), "interval-pairs")
    return pairs


# --- comparing intervals with a strip ------------------------------------------


def keys(turned_rows: np.ndarray, leading: int) -> np.ndarray:
    """Leading dimensions and the length of the rest: inner products of these are no smaller than the cosine."""
    rest = turned_rows[:, leading:]
    length = np.sqrt((rest * rest).sum(axis=1, keepdims=True)) * (1 + SLACK)
    return np.concatenate([turned_rows[:, :leading], length], axis=1).astype(np.float32)


def room(leading: int) -> float:
    """More than rounding to single precision takes from an inner product of keys."""
    return (leading + 4) * 2.0**-22


def leading_dimensions(vectors: DataFrame, turned: np.ndarray, cosine: float) -> int:
    """How many dimensions tell nearly all pairs of a sample apart. Any number gives the same links."""
    dimension = len(turned)
    x = unit(np.array([r["vector"] for r in vectors.collect()], float).reshape(-1, dimension)) @ turned if dimension > 8 else None
    for leading in range(8, dimension, 8):
        key = keys(x, leading)
        passed = key[:PIECE] @ key.T >= cosine - room(leading)
        if passed.sum() - (x[:PIECE] @ x.T >= cosine).sum() <= PASSED * passed.size:
            return leading
    return dimension


@dataclass
class Rows:
    """Rows of consecutive intervals, ready to be compared; pieces don't reach over intervals."""

    names: np.ndarray
    sizes: np.ndarray
    x: np.ndarray
    key: np.ndarray
    #: First and last row of each piece, the interval it is of, and its box.
    first: np.ndarray
    last: np.ndarray
    of: np.ndarray
    low: np.ndarray
    high: np.ndarray


def prepared(ids: Sequence[int], names: Sequence[bytes], sizes: Sequence[bytes], rows: Sequence[bytes], turned: np.ndarray, leading: int, kind: type) -> Rows:
    x = unit(np.frombuffer(b"".join(rows), kind).reshape(-1, len(turned)))
    at, first, last, of = 0, [], [], []
    for i, held in zip(ids, names, strict=True):
        end = at + len(held) // 16
        starts = range(at, end, PIECE)
        first += starts
        last += [min(k + PIECE, end) for k in starts]
        of += [i] * len(starts)
        at = end
    tx = x @ turned
    low, high = np.minimum.reduceat(tx, first), np.maximum.reduceat(tx, first)
    found = np.frombuffer(b"".join(names), "V16"), np.frombuffer(b"".join(sizes), "<i8")
    return Rows(*found, x, keys(tx, leading), np.array(first), np.array(last), np.array(of), low, high)


def near_pieces(strip: Rows, own: Rows, cosine: float) -> np.ndarray:
    """Whether the boxes of pieces are within epsilon."""
    gaps = np.zeros((len(strip.first), len(own.first)))
    for d in range(strip.low.shape[1]):
        gap = np.maximum(strip.low[:, d, None] - own.high[:, d], own.low[:, d] - strip.high[:, d, None])
        gaps += np.square(np.maximum(gap, 0, out=gap), out=gap)
    return gaps <= 2 - 2 * cosine + SLACK


def exact_links(x: np.ndarray, y: np.ndarray, i: np.ndarray, j: np.ndarray, cosine: float) -> np.ndarray:
    """Which of the places (i, j) have a cosine >= ``cosine``."""
    exact, step = np.zeros(len(i), bool), max(1, EXACT_BYTES // (8 * x.shape[1]))
    for at in range(0, len(i), step):
        some = slice(at, at + step)
        exact[some] = np.einsum("ij,ij->i", x[i[some]], y[j[some]]) >= cosine
    return exact


def links_of_pieces(strip: Rows, own: Rows, a: slice, b: slice, cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """Places (i, j) in two pieces with cosine >= ``cosine``."""
    least = cosine - room(strip.key.shape[1] - 1)
    bound = strip.key[a] @ own.key[b].T
    some = np.flatnonzero(bound.max(axis=1) >= least)
    if not len(some):
        return some, some
    i, j = np.nonzero(bound[some] >= least)
    x, y, i = strip.x[a], own.x[b], some[i]
    if len(i) <= WHOLE_SHARE * bound.size:
        exact = exact_links(x, y, i, j, cosine)
        return i[exact], j[exact]
    score = x @ y.T
    close = score >= cosine
    # Where rounding may decide, the sum is taken in one order everywhere.
    i, j = np.nonzero(np.abs(score - cosine) <= SLACK)
    close[i, j] = exact_links(x, y, i, j, cosine)
    return np.nonzero(close)


def first_places(values: np.ndarray) -> np.ndarray:
    """Where each value that occurs comes first; values lie near each other."""
    first = np.full(values.max() - values.min() + 1, -1)
    first[(values - values.min())[::-1]] = np.arange(len(values))[::-1]
    return first[first >= 0]


class Forest:
    """Links that connect what all links seen connect, each place with the smallest of its component."""

    def __init__(self, places: int):
        self.parent = np.arange(places)

    def roots(self, places: np.ndarray) -> np.ndarray:
        found = self.parent[places]
        while ((further := self.parent[found]) != found).any():
            found = further
        self.parent[places] = found
        return found

    def add(self, i: np.ndarray, j: np.ndarray) -> None:
        """One link of each i and of each j is added, then all go whose ends are connected, and so on."""
        while len(i):
            some = np.union1d(first_places(i), first_places(j))
            for a, b in zip(i[some].tolist(), j[some].tolist(), strict=True):
                a, b = self.root(a), self.root(b)
                self.parent[max(a, b)] = min(a, b)
            apart = self.roots(i) != self.roots(j)
            i, j = i[apart], j[apart]

    def root(self, place: int) -> int:
        while (up := int(self.parent[place])) != place:
            place = up
        return place


LINKS = "node binary, links long, other binary"


def link_rows(names: np.ndarray, total: np.ndarray, u: np.ndarray, others: np.ndarray) -> pa.RecordBatch:
    """Sums of the rows ``names``, and links of their places ``u`` with the names ``others``."""
    counted = np.flatnonzero(total)
    nodes = [names[k].tobytes() for k in np.concatenate([counted, u])]
    ends = [None] * len(counted) + [v.tobytes() for v in others]
    sums = np.concatenate([total[counted], np.zeros(len(u), np.int64)])
    arrays = [pa.array(nodes, pa.binary()), pa.array(sums, pa.int64()), pa.array(ends, pa.binary())]
    return pa.RecordBatch.from_arrays(arrays, ["node", "links", "other"])


def links_with_strip(dealt: DataFrame, sent: Broadcast, turned: np.ndarray, leading: int, cosine: float, kind: type) -> DataFrame:
    """LINKS between a strip and intervals ``dealt`` (id, partners, nodes, sizes, rows); ``partners`` are intervals of the strip."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        strip, starts = None, {}
        for batch in batches:
            for at in range(batch.num_rows):
                if strip is None:
                    ids, *columns = sent.value
                    strip = prepared(ids, *columns, turned, leading, kind)
                    starts = dict(zip(ids, np.cumsum([0] + [len(n) // 16 for n in columns[0]]).tolist(), strict=False))
                    total, forest, n = np.zeros(len(strip.x), np.int64), Forest(len(strip.x)), len(strip.x)
                me, partners, *own = (batch.column(c)[at].as_py() for c in ("id", "partners", "nodes", "sizes", "rows"))
                own = prepared([me], *([c] for c in own), turned, leading, kind)
                # An interval of the strip has its places there, others get some beyond them for a while.
                begin = starts.get(me, n)
                if begin == n:
                    total = np.concatenate([total, np.zeros(len(own.x), np.int64)])
                    forest.parent = np.concatenate([forest.parent, np.arange(n, n + len(own.x))])
                near = near_pieces(strip, own, cosine) & np.isin(strip.of, partners)[:, None]
                for p, q in zip(*np.nonzero(near), strict=True):
                    a, b = slice(strip.first[p], strip.last[p]), slice(own.first[q], own.last[q])
                    if strip.of[p] == me and begin + b.start < a.start:
                        continue
                    i, j = links_of_pieces(strip, own, a, b, cosine)
                    i, j = i + a.start, j + b.start + begin
                    if begin + b.start == a.start:
                        i, j = i[i < j], j[i < j]
                    if len(i):
                        np.add.at(total, i, own.sizes[j - begin])
                        np.add.at(total, j, strip.sizes[i])
                        forest.add(i, j)
                if begin == n:
                    # Roots are the smallest, so those of rows beyond the strip are in it.
                    u = np.flatnonzero(forest.parent[n:] != np.arange(n, len(forest.parent)))
                    yield link_rows(own.names, total[n:], u, strip.names[forest.roots(u + n)])
                    total, forest.parent = total[:n], forest.parent[:n]
        if strip is not None:
            u = np.flatnonzero(forest.parent != np.arange(n))
            yield link_rows(strip.names, total, u, strip.names[forest.roots(u)])

    return dealt.mapInArrow(work, LINKS)


def strips(cut: DataFrame, per: int) -> list[tuple[int, int]]:
    """First and last part of runs of parts with ``per`` rows at most, or of one part."""
    # A row for each task of the sort.
    parts = cut.select("part", F.octet_length("nodes").alias("n")).groupBy("part").agg((F.sum("n") / 16).alias("rows"))
    found, held = [], 0
    for r in sorted(parts.collect()):
        if found and held + r.rows <= per:
            found[-1], held = (found[-1][0], r.part), held + r.rows
        else:
            found, held = [*found, (r.part, r.part)], r.rows
    return found


def sent_strip(intervals: DataFrame) -> Broadcast:
    """(ids, nodes, sizes, rows) of a strip's intervals in their order."""
    held = sorted(intervals.select("id", "nodes", "sizes", "rows").collect())
    return intervals.sparkSession.sparkContext.broadcast(tuple(zip(*held, strict=True)))


def linked_intervals(
    cut: DataFrame, boxes: DataFrame, pairs: DataFrame, turned: np.ndarray, leading: int, cosine: float, element: str
) -> DataFrame:
    """LINKS of all pairs of intervals. Strip after strip meets the intervals from its first one on."""
    spark, kind = cut.sparkSession, number_type(element)
    path = scratch_path(spark, "vector-links")
    content = cut.select("part", "place", "nodes", "sizes", "rows")
    named = boxes.select("id", "part", "place")
    none = spark.createDataFrame([], LINKS)
    none.write.parquet(path)
    for first, last in strips(cut, STRIP_BYTES // (np.dtype(kind).itemsize * len(turned))):
        inside = named.filter(F.col("part").between(first, last))
        sent = sent_strip(content.filter(F.col("part").between(first, last)).join(F.broadcast(inside), ["part", "place"]))
        of_strip = pairs.join(F.broadcast(inside.select(F.col("id").alias("a"))), "a")
        partners = of_strip.groupBy("b").agg(F.collect_list("a").alias("partners"))
        wanted = named.join(F.broadcast(partners), named.id == partners.b).select("id", "part", "place", "partners")
        dealt = content.filter(F.col("part") >= first).join(F.broadcast(wanted), ["part", "place"])
        links = links_with_strip(dealt.select("id", "partners", "nodes", "sizes", "rows"), sent, turned, leading, cosine, kind)
        links.write.mode("append").parquet(path)
        sent.destroy()
    return spark.read.schema(none.schema).parquet(path)


def similar_vectors(table: DataFrame, cosine: float = COSINE, id_column: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(id, n_links, component_id, kept) for every row of ``table``.

    Two rows are linked if their vectors are of one length and their cosine, in double
    precision, is at least ``cosine``; equal vectors are. ``component_id`` is the
    smallest id that links lead to. A vector that is null, empty, zero, or holds a null
    or a number that isn't finite has no links and is its own component. Rows that
    repeat an id or a vector are rows of their own. A row without id belongs to the
    component of its links, and is kept where no row there has an id. An empty table
    gives an empty one. Other columns are not read.
    """
    ids = table.select(F.col(id_column).alias("id"), F.col(vector).alias("vector"))
    # A row for each length that occurs; vectors come from few models.
    lengths = sorted(r.d for r in ids.filter(F.size("vector") > 0).select(F.size("vector").alias("d")).distinct().collect())
    alone = ids.filter(~usable(F.col("vector"), F.size("vector")) | ~(F.size("vector") > 0) | F.col("vector").isNull())
    result = alone.select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    for dimension in lengths:
        result = result.unionByName(linked_vectors(table, dimension, cosine, id_column, vector))
    return result.select(
        F.col("id").alias(id_column), "n_links", "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept")
    )


def linked_vectors(table: DataFrame, dimension: int, cosine: float, id_column: str, vector: str) -> DataFrame:
    """(id, n_links, component_id) for the rows with a usable vector of one length."""
    rows = usable_rows(table, dimension, id_column, vector)
    named = materialize(named_rows(rows, dimension), "vectors")
    classes = materialize(named.groupBy("node").agg(F.min("id").alias("least"), F.count("*").alias("size")), "vector-classes")
    vectors = counted_vectors(rows, dimension)
    chosen = classes.select("node").orderBy("node").limit(SAMPLE)
    sample = vectors.join(F.broadcast(chosen), "node").groupBy("node").agg(F.any_value("vector").alias("vector"))
    sample = materialize(sample, "vector-sample")
    turned = principal_dimensions(sample, dimension)
    leading = leading_dimensions(sample, turned, cosine)
    cut = materialize(intervals(vectors, turned, cosine, classes.count()), "intervals")
    boxes = materialize(numbered(cut.select("part", "place", "box")), "numbered")
    pairs = near_intervals(boxes, dimension, cosine)
    element = table.schema[vector].dataType.elementType.simpleString()
    links = linked_intervals(cut, boxes, pairs, turned, leading, cosine, element)
    counted = links.groupBy("node").agg(F.sum("links").alias("links"))
    roots = components(links.filter("other IS NOT NULL").select(F.col("node").alias("u"), F.col("other").alias("v")))
    judged = classes.select("node", "least", "size").join(counted, "node", "left").join(roots, "node", "left")
    judged = materialize(judged.withColumn("root", F.coalesce("root", "node")), "judged")
    least = materialize(judged.groupBy("root").agg(F.min("least").alias("component_id")), "roots")
    result = judged.join(least, "root").select(
        "node", (F.col("size") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), "component_id"
    )
    return named.select("id", "node").join(materialize(result, "vector-results"), "node").select("id", "n_links", "component_id")
