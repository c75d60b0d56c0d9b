"""Ranked lexical search for many items at once, with common parts of the items scored once.

An item is a set of terms, and a document's score for it is a sum over them. Terms that
occur in the same items are one part; parts that stand next to each other in two items
or more, in an order that puts the most shared first, are joined to larger parts, round
after round. What comes out is a graph of sums: a part is the sum of two smaller ones,
an item the sum of a few parts, and parts are shared by all items that hold them.

The texts are read once, for the items' terms in each document. Then, for a block of
documents at a time, the accumulators of the smallest parts are filled from the terms,
those of larger ones are added up from them once, and items take theirs from the graph.
A task keeps the best documents of every item, and these meet in small aggregations.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from newsloom.llm.units import pack_numbers, unpack_numbers
from newsloom.llm.words import NOT_ALNUM, find_words, give_back, slices, word_hashes
from newsloom.scratch import materialize

TOP = 50
#: Terms of all items of a group, which is sent to all tasks; more items are answered group by group.
GROUP_TERMS = 1 << 18
#: UTF-8 bytes of the texts of a stored block, and bytes of accumulators that are held at once.
TEXT_BYTES = 1 << 19
ACCUMULATOR_BYTES = 8 << 20
#: Candidates that a task holds before it keeps the best of each item only.
POOL = 200_000
#: Sub-groups of an item between the tasks and its result.
SALTS = 64


# --- the graph of sums ----------------------------------------------------------


@dataclass
class Graph:
    """Items as sums of shared parts.

    ``terms``: sorted hashes; ``part``: the smallest part of each. Parts are numbered
    from 0, the smallest first; ``rounds`` holds the two summands of the parts that
    follow. Item i is the sum of ``nodes[first[i]:first[i + 1]]``.
    """

    items: pa.Array
    terms: np.ndarray
    part: np.ndarray
    parts: int
    rounds: list[tuple[np.ndarray, np.ndarray]] = field(default_factory=list)
    nodes: np.ndarray | None = None
    first: np.ndarray | None = None

    @property
    def size(self) -> int:
        return self.parts + sum(len(left) for left, _ in self.rounds)

    @property
    def additions(self) -> int:
        """For a document that holds all terms."""
        return len(self.terms) - self.parts + self.size - self.parts + len(self.nodes) - len(self.items)


def shared_parts(item: np.ndarray, term: np.ndarray, terms: int) -> np.ndarray:
    """The smallest part of every term: terms of the same items are one."""
    order = np.lexsort((item, term))
    begins = np.searchsorted(term[order], np.arange(terms + 1))
    held, number = item[order].astype(np.int64), {}
    return np.array([number.setdefault(held[a:b].tobytes(), len(number)) for a, b in zip(begins[:-1], begins[1:], strict=True)], np.int64)


def joined_pairs(item: np.ndarray, node: np.ndarray, next_node: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray] | None:
    """One round: (item, node, left, right) after neighbours that two items or more have in common are joined.

    Of neighbouring pairs the one that more items hold goes first. None if no pair is left.
    """
    pair = np.flatnonzero(item[1:] == item[:-1])
    code = node[pair] << np.int64(32) | node[pair + 1]
    distinct, place, count = np.unique(code, return_inverse=True, return_counts=True)
    # A pair's place in the order (items that hold it, code) decides against the pairs that overlap it.
    weight = np.empty(len(distinct), np.int64)
    weight[np.lexsort((distinct, count))] = np.arange(1, len(distinct) + 1)
    at = np.zeros(len(node) + 1, np.int64)
    at[pair] = np.where(count[place] > 1, weight[place], 0)
    before = np.concatenate([[0], at[:-2]])
    chosen = np.flatnonzero((at[:-1] > before) & (at[:-1] > at[1:]))
    code = node[chosen] << np.int64(32) | node[np.minimum(chosen + 1, len(node) - 1)]
    distinct, place, count = np.unique(code, return_inverse=True, return_counts=True)
    often = count > 1
    if not often.any():
        return None
    number = np.cumsum(often) - 1 + next_node
    chosen, place = chosen[often[place]], place[often[place]]
    node = node.copy()
    node[chosen] = number[place]
    stays = np.ones(len(node), bool)
    stays[chosen + 1] = False
    distinct = distinct[often]
    return item[stays], node[stays], distinct >> np.int64(32), distinct & np.int64(0xFFFFFFFF)


def graph_of(items: pa.Array, item: np.ndarray, hashes: np.ndarray) -> Graph:
    """The graph for distinct (item, hash) entries; ``item`` are places in ``items``."""
    terms, term = np.unique(hashes, return_inverse=True)
    part = shared_parts(item, term, len(terms))
    parts = int(part.max(initial=-1)) + 1
    entry = np.unique(item.astype(np.int64) << np.int64(32) | part[term])
    item, node = entry >> np.int64(32), entry & np.int64(0xFFFFFFFF)
    support = np.bincount(node, minlength=parts)
    order = np.lexsort((node, -support[node], item))
    item, node = item[order], node[order]
    graph = Graph(items, terms, part, parts)
    while (joined := joined_pairs(item, node, graph.size)) is not None:
        item, node, left, right = joined
        graph.rounds.append((left, right))
    graph.nodes, graph.first = node, np.searchsorted(item, np.arange(len(items) + 1))
    return graph


def item_terms(items: DataFrame) -> DataFrame:
    """(item_id, h): the distinct terms of every item."""
    kind = items.schema["item_id"].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in slices(batches, "text", TEXT_BYTES):
            words = find_words(rows.column("text"), NOT_ALNUM, lower=True)
            at = pa.array(words.text_of_word())
            hashes = pa.array(word_hashes(words).view(np.int64))
            yield pa.RecordBatch.from_arrays([rows.column("item_id").take(at), hashes], ["item_id", "h"])

    return items.select("item_id", "text").mapInArrow(work, f"item_id {kind}, h long").distinct()


def graphs(terms: DataFrame, groups: int) -> DataFrame:
    """(part, graph): items dealt to groups, and a pickled graph for each."""

    def work(table: pa.Table) -> pa.Table:
        table = table.sort_by("item_id").combine_chunks()
        ids = table.column("item_id").combine_chunks()
        if isinstance(ids, pa.ChunkedArray):
            ids = pa.concat_arrays(ids.chunks)
        items = pc.unique(ids)
        at = pc.index_in(ids, items).to_numpy().astype(np.int64)
        hashes = table.column("h").to_numpy().view(np.uint64)
        return pa.table({"part": table.column("part").slice(0, 1), "graph": pa.array([pickle.dumps(graph_of(items, at, hashes))])})

    dealt = terms.withColumn("part", F.pmod(F.xxhash64("item_id"), F.lit(groups)).cast("int"))
    return dealt.groupBy("part").applyInArrow(work, "part int, graph binary")


# --- documents ----------------------------------------------------------------


def blocks_of(docs: DataFrame, vocabulary) -> DataFrame:
    """(ids, lengths, counts, terms, times, n_docs, n_terms): blocks of documents with the vocabulary's terms in them."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary.value
        for rows in slices(batches, "text", TEXT_BYTES):
            words = find_words(rows.column("text"), NOT_ALNUM, lower=True)
            hashes, length = word_hashes(words), words.count
            at = np.searchsorted(known, hashes).clip(max=len(known) - 1)
            hit = known[at] == hashes
            entries, times = np.unique(words.text_of_word()[hit] * len(known) + at[hit], return_counts=True)
            text, term = entries // len(known), entries % len(known)
            numbers = [length, np.bincount(text, minlength=rows.num_rows), term, times]
            packed = [pa.array([pack_numbers(x.astype(np.uint64))], pa.binary()) for x in numbers]
            ids = pa.ListArray.from_arrays(pa.array([0, rows.num_rows], pa.int32()), rows.column("doc_id"))
            totals = [pa.array([int((length > 0).sum())]), pa.array([int(length.sum())])]
            yield pa.RecordBatch.from_arrays([ids, *packed, *totals], ["ids", "lengths", "counts", "terms", "times", "n_docs", "n_terms"])

    schema = f"ids array<{kind}>, lengths binary, counts binary, terms binary, times binary, n_docs long, n_terms long"
    return docs.select("doc_id", "text").mapInArrow(work, schema)


def holding_documents(blocks: DataFrame, terms: int) -> np.ndarray:
    """How many documents hold each term."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(terms, np.int64)
        for batch in batches:
            for packed in batch.column("terms").to_pylist():
                total += np.bincount(unpack_numbers(packed).astype(np.int64), minlength=terms)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["term", "df"])

    out = np.zeros(terms, np.int64)
    counted = blocks.select("terms").mapInArrow(work, "term long, df long").groupBy("term").agg(F.sum("df").alias("df"))
    for row in counted.collect():
        out[row.term] = row.df
    return out


def term_weights(held: np.ndarray, n_docs: int) -> np.ndarray:
    return np.floor(1000 * np.log((2 * n_docs + 2) / (2 * held + 1))).astype(np.int64)


def contributions(length: np.ndarray, times: np.ndarray, weight: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """What each entry (a term in a document) adds to a score, in whole numbers."""
    m = 50 + (50 * length * n_docs) // n_terms
    return weight * ((1_000_000_000 * times) // (1000 * times + 20 * m))


def accumulators(graph: Graph, doc: np.ndarray, term: np.ndarray, adds: np.ndarray, docs: int) -> np.ndarray:
    """(parts of the graph, docs): every part is summed up once."""
    out = np.zeros((graph.size, docs), np.int64)
    np.add.at(out, (graph.part[term], doc), adds)
    at = graph.parts
    for left, right in graph.rounds:
        np.add(out[left], out[right], out=out[at : at + len(left)])
        at += len(left)
    return out


def item_scores(graph: Graph, sums: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(first item, scores of some items by document)."""
    step = max(1, len(graph.items) * ACCUMULATOR_BYTES // (8 * max(1, len(graph.nodes)) * max(1, sums.shape[1])))
    for begin in range(0, len(graph.items), step):
        end = min(begin + step, len(graph.items))
        places = graph.first[begin : end + 1]
        rows = sums[graph.nodes[places[0] : places[-1]]]
        # Every item has a part at least.
        yield begin, np.add.reduceat(rows, places[:-1] - places[0], axis=0)


class Pool:
    """The best documents of each item so far."""

    def __init__(self, items: int, top: int, ids: pa.DataType):
        self.items, self.top = items, top
        self.least = np.ones(items, np.int64)
        self.kept = pa.table({"item": pa.array([], pa.int64()), "score": pa.array([], pa.int64()), "doc_id": pa.array([], ids)})
        self.new: list[pa.Table] = []
        self.held = 0

    def add(self, begin: int, scores: np.ndarray, ids: pa.Array) -> None:
        item, doc = np.nonzero(scores >= self.least[begin : begin + len(scores), None])
        if len(item):
            columns = {"item": pa.array(item + begin), "score": pa.array(scores[item, doc]), "doc_id": ids.take(pa.array(doc))}
            self.new.append(pa.table(columns))
            self.held += len(item)
        if self.held > POOL:
            self.cut()

    def cut(self) -> pa.Table:
        table = pa.concat_tables([self.kept, *self.new])
        keys = [("item", "ascending"), ("score", "descending"), ("doc_id", "ascending")]
        table = table.take(pc.sort_indices(table, keys, null_placement="at_start"))
        item = table.column("item").to_numpy()
        rank = np.arange(len(item)) - np.searchsorted(item, item)
        self.kept, self.new, self.held = table.filter(pa.array(rank < self.top)), [], 0
        last = np.flatnonzero(rank == self.top - 1)
        self.least[item[last]] = table.column("score").to_numpy()[last]
        return self.kept


def best_of_tasks(blocks: DataFrame, graph, weights, totals: tuple[int, int], top: int, doc_kind: str, item_kind: str) -> DataFrame:
    """(item_id, doc_id, score): the best documents of every item in every task."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dag: Graph = graph.value
        weight = weights.value
        pool = None
        step = max(1, ACCUMULATOR_BYTES // (8 * max(1, dag.size)))
        for batch in batches:
            for at in range(batch.num_rows):
                ids = batch.column("ids")[at].values
                pool = pool or Pool(len(dag.items), top, ids.type)
                unpacked = lambda c: unpack_numbers(batch.column(c)[at].as_py()).astype(np.int64)  # noqa: B023, E731
                length, term, times = unpacked("lengths"), unpacked("terms"), unpacked("times")
                counts = unpacked("counts") if len(ids) else np.zeros(0, np.int64)
                first = np.concatenate([[0], np.cumsum(counts)])
                doc = np.repeat(np.arange(len(ids)), counts)
                adds = contributions(length[doc], times, weight[term], *totals)
                for begin in range(0, len(ids), step):
                    end = min(begin + step, len(ids))
                    some = slice(first[begin], first[end])
                    sums = accumulators(dag, doc[some] - begin, term[some], adds[some], end - begin)
                    for item, scores in item_scores(dag, sums):
                        pool.add(item, scores, ids.slice(begin, end - begin))
        if pool is not None:
            found = pool.cut()
            named = found.set_column(0, "item_id", dag.items.take(found.column("item").combine_chunks()))
            yield from named.select(["item_id", "doc_id", "score"]).combine_chunks().to_batches()
        give_back()

    return blocks.drop("n_docs", "n_terms").mapInArrow(work, f"item_id {item_kind}, doc_id {doc_kind}, score long")


# --- the search ---------------------------------------------------------------


def ranked_documents(docs: DataFrame, items: DataFrame, top: int = TOP) -> DataFrame:
    """item_id, rank, doc_id, score: the ``top`` documents of ``docs`` (doc_id, text) for each of ``items`` (item_id, text).

    Terms are runs of ASCII letters, digits and other than ASCII characters, A-Z
    lower-cased. A term in a document adds its weight times 1000000000 tf / (1000 tf +
    20 m), in whole numbers, where the weight falls with the documents that hold it and
    m grows with the document's length (see the functions for both). Only scores above
    0 count; equal ones are ranked by doc_id.

    Null and empty texts have no terms: such items have no rows, such documents no
    score. Rows that repeat an item_id are one item with the terms of all; items
    without id are one such item. Rows that repeat a doc_id are ranked one by one, rows
    without doc_id go first among equal scores. An empty table on either side gives an
    empty result. Texts may be of any length; a task holds some 60 bytes for each byte
    of the longest. Other columns are not read. Terms are compared by 64-bit hashes.
    """
    spark = docs.sparkSession
    kinds = [docs.schema["doc_id"].dataType.simpleString(), items.schema["item_id"].dataType.simpleString()]
    terms = materialize(item_terms(items), "item-terms")
    groups = max(1, -(-terms.count() // GROUP_TERMS))
    mined = materialize(graphs(terms, groups), "graphs")
    found = spark.createDataFrame([], f"item_id {kinds[1]}, doc_id {kinds[0]}, score long")
    for row in mined.select("part").orderBy("part").collect():
        # One group at a time: its terms and graph are bounded, the documents are read for each.
        graph: Graph = pickle.loads(mined.filter(F.col("part") == row.part).first().graph)
        blocks = materialize(blocks_of(docs, spark.sparkContext.broadcast(graph.terms)), "term-blocks")
        n_docs, n_terms = blocks.agg(F.sum("n_docs"), F.sum("n_terms")).first()
        if not n_terms:
            break
        weights = term_weights(holding_documents(blocks, len(graph.terms)), n_docs)
        sent = spark.sparkContext.broadcast(graph), spark.sparkContext.broadcast(weights)
        found = found.unionByName(best_of_tasks(blocks, *sent, (n_docs, n_terms), top, *kinds))
    order = [F.desc("score"), F.asc_nulls_first("doc_id")]
    salted = found.withColumn("salt", F.spark_partition_id() % SALTS)
    first = salted.withColumn("rank", F.row_number().over(Window.partitionBy("item_id", "salt").orderBy(*order)))
    last = first.filter(F.col("rank") <= top).withColumn("rank", F.row_number().over(Window.partitionBy("item_id").orderBy(*order)))
    return last.filter(F.col("rank") <= top).select("item_id", "rank", "doc_id", "score")
