import random
import re

import pytest
from pyspark.sql import functions as F

from newsloom.llm import line_dedup as L
from newsloom.llm import queries

SCHEMA = "doc_id long, text string, h long, _dropped string, line_no int"


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) <= 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def words(line):
    return tuple(re.findall(r"[^ \t\x0b\f\r]+", line))


def plain(docs, least=L.MIN_WORDS):
    first, out = {}, []
    key = lambda i, n: ((i is not None, i or 0), n)
    for i, t, *_ in docs:
        for n, line in enumerate((t or "").split("\n")):
            if words(line):
                first[words(line)] = min(first.get(words(line), key(i, n)), key(i, n))
    long = [ws for ws in first if len(ws) >= least]
    gone = {a for a in long for b in long if first[b] < first[a] and near(a, b)}
    for i, t, *_ in docs:
        lines = (t or "").split("\n")
        keep = [
            x for n, x in enumerate(lines) if not words(x) or (words(x) not in gone and first[words(x)] == key(i, n))
        ]
        out.append((i, t if t is None else "\n".join(keep), len(lines) - len(keep)))
    return out


def made(seed):
    rng = random.Random(seed)
    line = lambda n: " ".join(rng.choices("a b c é the".split(), k=n))
    pool = [line(rng.choice([4, 5, 6, 7])) for _ in range(60)] + ["page number %d of the book" % i for i in range(40)]
    docs = [(i, "\n".join(rng.choice(pool).replace(" ", rng.choice([" ", "  ", "\t"])) for _ in range(rng.randrange(1, 9))), 0, "", 0) for i in range(60)]
    docs += [(100, None, 0, "", 0), (101, "", 0, "", 0), (102, "\n\n", 0, "", 0), (103, "x y z " * 300, 0, "", 0), (104, "x y z " * 300 + "w", 0, "", 0)]
    docs += [docs[7], docs[7], (7, pool[3] + "\nanother line under the same id", 0, "", 0), (None, pool[5] + "\n" + pool[6], 0, "", 0)]
    return docs


@pytest.mark.parametrize("seed, broadcast", [(1, 1 << 20), (2, 0)])
def test_against_all_pairs(spark, seed, broadcast, monkeypatch):
    monkeypatch.setattr(L, "BROADCAST_BYTES", broadcast)
    monkeypatch.setattr(L, "BROADCAST_KEYS", broadcast)
    rows = made(seed)
    docs = spark.createDataFrame(rows, SCHEMA)
    got = L.dedup_lines(docs)
    assert got.columns == [*docs.columns, "lines_removed"]
    found = sorted(((r.doc_id, r.text, r.lines_removed) for r in got.collect()), key=str)
    expected = sorted(plain(rows), key=str)
    assert found == expected and sum(e[2] for e in expected) > 50


def test_distance(spark):
    rng = random.Random(4)
    pairs = [tuple([rng.choice("ab") for _ in range(rng.randrange(1, 6))] for _ in "ab") for _ in range(500)]
    table = spark.createDataFrame(pairs, "a array<string>, b array<string>")
    got = table.select("a", "b", L.near(F.col("a"), F.col("b")).alias("near")).collect()
    assert all(r.near == near(tuple(r.a), tuple(r.b)) for r in got)


def test_variants_number_one_for_each_word(spark):
    lines = spark.createDataFrame([((1, 2), 5, ["a", "b", "b", "c"])], "place struct<doc_id: long, line_no: int>, h long, ws array<string>")
    got = L.variants_of(lines).collect()
    assert sorted(r.pos for r in got) == [-1, 0, 1, 2, 3] and len({r.v for r in got}) == 4


def test_empty(spark):
    assert L.dedup_lines(spark.createDataFrame([], SCHEMA)).collect() == []


def test_sql_on_lines_with_tabs_and_double_spaces(spark, tmp_path):
    duckdb = pytest.importorskip("duckdb")
    seen, rows = set(), []
    for row in made(3):
        if row[0] is not None and row[0] not in seen:
            seen.add(row[0])
            rows.append(row[:2])
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    cursor = con.execute(queries.SQL["op2_line_dedup"])
    names = [d[0] for d in cursor.description]
    expected = sorted(tuple(r) for r in cursor.fetchall())
    got = queries.op2_line_dedup(spark, str(tmp_path)).select(*names).collect()
    assert sorted(tuple(r) for r in got) == expected and sum(r[2] for r in expected) > 50
