"""Sharding by a hierarchical weighted hash tree: region, rack, shard.

At every level a row draws ``-ln(u) / weight`` for each child, ``u`` being a hash
of its key and the child's name, and descends into the child with the smallest
draw, which it therefore takes with probability ``weight / sum of weights``. A
draw depends on nothing but the key and that child, so a change of weights moves
rows only into or out of the subtrees whose weights changed. A shard that is added
as a region of its own changes no weight of another, so it takes rows only into
itself.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.llm.ranks import with_rank


@dataclass(frozen=True)
class Node:
    """A region or rack (``children``), or a shard (``shard`` and its own weight)."""

    name: str
    children: tuple[Node, ...] = ()
    shard: int | None = None
    own_weight: float = 1.0
    weight: float = field(init=False)

    def __post_init__(self) -> None:
        if (self.shard is None) == (not self.children):
            raise ValueError(f"{self.name}: give either children or a shard number")
        if self.shard is not None and not self.own_weight > 0:
            raise ValueError(f"{self.name}: the weight must be above 0")
        total = sum(c.weight for c in self.children) if self.children else self.own_weight
        object.__setattr__(self, "weight", float(total))


def even_tree(shards: int, racks_per_region: int = 2, shards_per_rack: int = 4) -> Node:
    """``shards`` equal shards numbered from 0, in full racks and regions as far as they go."""
    if shards < 1:
        raise ValueError("at least one shard is needed")
    leaves = [Node(f"shard-{n}", shard=n) for n in range(shards)]
    racks = [
        Node(f"rack-{n}", tuple(leaves[at : at + shards_per_rack]))
        for n, at in enumerate(range(0, shards, shards_per_rack))
    ]
    regions = [
        Node(f"region-{n}", tuple(racks[at : at + racks_per_region]))
        for n, at in enumerate(range(0, len(racks), racks_per_region))
    ]
    return Node("root", tuple(regions))


def grown(tree: Node, weight: float = 1.0) -> Node:
    """``tree`` with one more shard, in a region of its own: only it gains rows."""
    number = 1 + max(leaf.shard for leaf in leaves(tree))
    shard = Node(f"shard-{number}", shard=number, own_weight=weight)
    region = Node(f"region-of-shard-{number}", (Node(f"rack-of-shard-{number}", (shard,)),))
    return Node(tree.name, (*tree.children, region))


def leaves(node: Node) -> list[Node]:
    return [node] if node.shard is not None else [leaf for c in node.children for leaf in leaves(c)]


def draw(key: Column, node: Node) -> Column:
    """An exponential clock of rate ``node.weight``, the same wherever the node hangs."""
    bits = F.shiftrightunsigned(F.xxhash64(key, F.lit(node.name)), 11)
    return -F.log((bits + F.lit(0.5)) / F.lit(2.0**53)) / F.lit(node.weight)


def winner(key: Column, children: tuple[Node, ...]) -> Column:
    """Place of the child with the smallest draw, the first of equals."""
    if len(children) == 1:
        return F.lit(0)
    return F.least(*(F.struct(draw(key, c).alias("d"), F.lit(i).alias("i")) for i, c in enumerate(children)))["i"]


def place(rows: DataFrame, tree: Node, key: str, into: str) -> DataFrame:
    """Add ``into``, the shard of each row. Equal keys share a shard, null ones too."""
    level = [(F.lit(True), tree)]
    steps: list[str] = []
    while any(n.shard is None for _, n in level):
        step = f"_{into}_{len(steps)}"
        choice = F.lit(0)
        for condition, node in reversed(level):
            if node.children:
                choice = F.when(condition, winner(F.col(key), node.children)).otherwise(choice)
        rows = rows.withColumn(step, choice)
        level = [
            (condition & (F.col(step) == i), child)
            for condition, node in level
            for i, child in enumerate(node.children or (node,))
        ]
        steps.append(step)
    shard = F.lit(level[-1][1].shard)
    for condition, node in reversed(level[:-1]):
        shard = F.when(condition, F.lit(node.shard)).otherwise(shard)
    return rows.withColumn(into, shard).drop(*steps)


def shard_documents(docs: DataFrame, shards: int = 16, key: str = "doc_id") -> DataFrame:
    """Size, checksum, shard, slot and the shard after growth by one, for each row.

    ``key`` and the number of shards decide (law ``key``). Sizes are the UTF-8 bytes
    of the text plus 1. A null text has size 1 and the checksum of no bytes; rows
    with a null key share one shard, repeated keys too, and each row has a slot of
    its own. Other columns of ``docs`` are not read. An empty table gives no rows.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    tree = even_tree(shards)
    rows = docs.select(
        F.col(key),
        (F.octet_length(text) + F.lit(1)).cast("long").alias("size"),
        F.crc32(text).cast("long").alias("text_crc32"),
        F.lit("key").alias("law"),
    )
    rows = place(place(rows, tree, key, "shard"), grown(tree), key, "grown_shard")
    order = [F.col(key), F.col("size"), F.col("text_crc32")]
    return with_rank(rows, "shard", order, "slot", F.col(key)).select(
        key, "size", "text_crc32", "law", "shard", F.col("slot").cast("long"), "grown_shard"
    )
