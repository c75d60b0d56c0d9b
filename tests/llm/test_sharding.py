import zlib
from collections import Counter, defaultdict

from newsloom.llm.sharding import Node, even_tree, grown, leaves, place, shard_documents


def docs(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, slot string, _block int")


def test_contract_on_awkward_rows(spark):
    rows = [(i, None if i % 7 == 0 else "" if i % 5 == 0 else "é" * (i % 50), "x", 1) for i in range(3000)]
    rows += [(5, "again", "x", 1), (5, "again", "x", 1), (None, "no key", "x", 1), (None, None, None, None)]
    got = shard_documents(docs(spark, rows)).collect()
    assert len(got) == len(rows)
    expected = Counter((d, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t, *_ in rows)
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in got) == expected
    slots = defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
        assert r.law == "key" and r.grown_shard in (r.shard, 16)
    assert set(slots) == set(range(16))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert len({r.shard for r in got if r.doc_id == 5}) == 1
    moved = sum(r.grown_shard != r.shard for r in got)
    assert 90 < moved < 280


def test_slots_of_a_group_larger_than_a_block(spark):
    from pyspark.sql import functions as F

    from newsloom.llm.ranks import with_rank

    rows = spark.range(5000).select("id", F.when(F.col("id") % 3 > 0, "hot").alias("g"))
    got = with_rank(rows, "g", [F.col("id")], "at", F.col("id"), rows_per_block=100).collect()
    for g in ("hot", None):
        at = sorted(r["at"] for r in got if r.g == g)
        assert at == list(range(len(at))) and at


def test_weights_and_confined_movement(spark):
    def tree(w):
        return Node(
            "root",
            (
                Node("a", (Node("a1", shard=0, own_weight=w), Node("a2", shard=1))),
                Node("b", (Node("b1", shard=2), Node("b2", shard=3))),
            ),
        )

    rows = spark.range(20000).withColumnRenamed("id", "k")
    got = place(place(rows, tree(1.0), "k", "x"), tree(3.0), "k", "y").collect()
    shares = Counter(r.y for r in got)
    assert abs(shares[0] / 20000 - 3 / 6) < 0.02 and abs(shares[2] / 20000 - 1 / 6) < 0.02
    assert not any(r.x in (0, 1) and r.y in (2, 3) for r in got), "rows leave only the other subtree"
    assert not any({r.x, r.y} == {2, 3} for r in got)
    assert not any(r.x == 0 and r.y == 1 for r in got)


def test_growth_keeps_taking_rows_only_into_the_new_shard(spark):
    tree = even_tree(3)
    rows = spark.range(5000).withColumnRenamed("id", "k")
    for _ in range(3):
        wider = grown(tree)
        new = max(leaf.shard for leaf in leaves(wider))
        got = place(place(rows, tree, "k", "x"), wider, "k", "y").collect()
        assert all(r.y in (r.x, new) for r in got) and any(r.y == new for r in got)
        tree = wider


def test_empty(spark):
    assert shard_documents(docs(spark, [])).collect() == []
