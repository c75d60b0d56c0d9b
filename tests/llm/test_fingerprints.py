import hashlib
import random

import numpy as np
import pytest

from newsloom.llm import fingerprints as P
from newsloom.llm.queries import op12_fingerprints, table

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, tie int, fingerprint string, last string"


def plain_hash(text, base):
    return sum((ord(c) + 1) * pow(base, i, P.PRIME) for i, c in enumerate(text)) % P.PRIME


def common(a, b):
    n = 0
    while n < min(len(a), len(b)) and a[n] == b[n]:
        n += 1
    return n


def texts(seed=0):
    rng = random.Random(seed)
    made = ["".join(rng.choices("abc é漢😀\n", k=n)) for n in (0, 1, 2, 3, 5, 11, 12, 13, 40, 300, 2000)]
    return made + ["ab" * 400, "x" * 70_000, made[-1] + "more", made[-1][:900] + "Z" + made[-1][900:]]


def test_prefix_arrays():
    some = texts()
    row = P.PrefixHashes(some)
    for i, t in enumerate(some):
        if len(t) > 3000:
            continue
        for at in {0, len(t) // 3, len(t)}:
            got = int(row.prefixes(np.array([i]), np.array([at]))[0])
            assert (got >> 31, got & P.PRIME) == tuple(plain_hash(t[:at], b) for b in P.BASES)
    exponents = np.array([0, 1, 5, 65535, 65536, 1_000_003])
    for base in P.BASES:
        assert P.power(base, exponents).tolist() == [pow(base, int(e), P.PRIME) for e in exponents]


def test_spans_and_common_extensions():
    some = texts(1)
    row = P.PrefixHashes(some)
    rng = random.Random(2)
    places = [(rng.randrange(len(row.codes)), rng.randrange(len(row.codes))) for _ in range(300)]
    places += [(int(row.first[10]) + k, int(row.first[13]) + k) for k in range(0, 2000, 300)]
    places += [(int(row.first[11]) + k, int(row.first[11])) for k in range(0, 8)]
    a, b = np.array(places).T
    joined = "".join(some)
    end = lambda x: int(row.first[np.searchsorted(row.first, x, "right")])
    expected = [common(joined[x : end(x)], joined[y : end(y)]) for x, y in places]
    assert row.common_extension(a, b).tolist() == expected and 2000 in expected
    length = np.array([3] * len(a))
    inside = (a + 3 <= len(row.codes)) & (b + 3 <= len(row.codes))
    same = row.equal(a[inside], b[inside], length[inside])
    assert same.tolist() == [joined[x : x + 3] == joined[y : y + 3] for x, y in zip(a[inside].tolist(), b[inside].tolist())]


def plain_anchors(text):
    """Marks of all windows from their own hashes, the smallest at their first places."""
    first = {}
    for at in range(len(text) - P.WINDOW + 1):
        first.setdefault(plain_hash(text[at : at + P.WINDOW], P.BASES[0]), at)
    marks = {int(P.mix(np.array([h], np.uint64), 12)[0] >> np.uint64(32)): at for h, at in first.items()}
    return [(at, mark) for mark, at in sorted(marks.items())[: P.ANCHORS]]


def test_fingerprints_from_their_definition():
    some = [t for t in texts(3) if len(t) < 3000]
    found = P.fingerprints(P.PrefixHashes(some))
    for i, t in enumerate(some):
        whole = tuple(plain_hash(t, b) for b in P.BASES)
        assert found.length[i] == len(t) and (int(found.whole[i]) >> 31, int(found.whole[i]) & P.PRIME) == whole
        n = int((found.place[i] >= 0).sum())
        assert list(zip(found.place[i, :n].tolist(), found.mark[i, :n].tolist())) == plain_anchors(t)
        for at, hashed in zip(found.place[i, :n].tolist(), found.anchor[i, :n].tolist()):
            assert (hashed >> 31, hashed & P.PRIME) == tuple(plain_hash(t[:at], b) for b in P.BASES)
        for at, hashed in zip(P.GRID[P.GRID < len(t)].tolist(), found.grid[i].tolist()):
            assert (hashed >> 31, hashed & P.PRIME) == tuple(plain_hash(t[:at], b) for b in P.BASES)
    again = P.parse(found.strings())
    for f in found.__dataclass_fields__:
        assert (getattr(again, f) == getattr(found, f)).all()


def of(*some):
    return P.fingerprints(P.PrefixHashes(list(some)))


def like(a, b):
    return float(P.likeness(of(a), of(b))[0])


def test_likeness():
    rng = random.Random(5)
    words = lambda n: " ".join(rng.choices([f"w{k}" for k in range(400)], k=n))
    a, b = words(500), words(500)
    assert like(a, a) == 1 and like("", "") == 1 and like("", "x") == 0 and like(a, b) < 0.02
    # Never more than what is equal, and most of it.
    assert 0.68 < like(a, a[: len(a) * 3 // 4] + b[: len(a) // 4]) <= 0.76
    half = len(a) // 2
    assert like(a, a[:half] + "inserted" + a[half:]) > 0.85
    assert like(a, "something in front. " + a) > 0.8
    assert like(a, b + a) > 0.6
    assert like(a, a) == like(a[:], a) and like(a, b + a) == pytest.approx(like(b + a, a), abs=0.05)
    for n in (4, 8, 20, 60):
        t = words(50)[:n]
        assert like(t, t[: n - n // 4] + "#" * (n // 4)) >= 0.5


def plain(rows):
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    out = []
    for k, (i, t) in enumerate(order):
        following = order[(k + 1) % len(order)][1] or ""
        t = t or ""
        cut = len(t) // 4
        edited = t[: len(t) - cut] + following[:cut]
        prints = [of(x) for x in (t, edited, following)]
        near = [float(P.likeness(prints[0], p)[0]) for p in prints[1:]]
        strings = [p.strings()[0] for p in prints[:2]]
        out.append((i, len(t), hashlib.sha256(edited.encode()).hexdigest(), *strings, *near))
    return sorted(out, key=str)


COLUMNS = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]


@pytest.mark.parametrize("part_bytes, text_bytes", [(16 << 20, 1 << 18), (2000, 500)])
def test_against_plain(spark, monkeypatch, part_bytes, text_bytes):
    monkeypatch.setattr(P, "PARTITION_BYTES", part_bytes)
    monkeypatch.setattr(P, "TEXT_BYTES", text_bytes)
    rows = [(i * 3, t) for i, t in enumerate(texts(7))] + [(100, None), (101, ""), (102, None), (None, "no id here " * 5), (99, texts(7)[9])]
    random.Random(1).shuffle(rows)
    docs = spark.createDataFrame([(*r, 1, "x", "y") for r in rows], SCHEMA)
    got = P.fingerprint_documents(docs)
    assert got.columns == COLUMNS
    assert sorted((tuple(r) for r in got.collect()), key=str) == plain(rows)


def test_repeated_ids_and_small_tables(spark):
    schema = "doc_id string, text string"
    assert P.fingerprint_documents(spark.createDataFrame([], schema)).collect() == []
    (one,) = P.fingerprint_documents(spark.createDataFrame([("a", "alone with itself")], schema)).collect()
    assert one.edited_sha256 == hashlib.sha256(b"alone with itself"[:13] + b"alon").hexdigest() and one.near_next == 1
    rows = [("a", "same text again")] * 5 + [("a", "another text"), ("b", "last one of them")]
    got = P.fingerprint_documents(spark.createDataFrame(rows, schema)).collect()
    assert len(got) == 7 and len({r.fingerprint for r in got}) == 3
    assert sum(r.near_next == 1 for r in got) == 4


def test_many_rows_of_one_id(spark):
    rows = spark.range(20_000).selectExpr("7L AS doc_id", "concat('row ', id % 5000, ' of one document id') AS text")
    got = P.fingerprint_documents(rows)
    sizes = got.groupBy("n_chars").count().collect()
    assert sum(r["count"] for r in sizes) == 20_000


def test_query(spark):
    rows = [(r.doc_id, r.text) for r in table(spark, SF, "documents").collect()]
    got = sorted((tuple(r) for r in op12_fingerprints(spark, SF).collect()), key=str)
    assert got == plain(rows)
    long = [r for r in got if r[1] >= 200]
    assert min(r[5] for r in long) > 0.5 and np.mean([r[5] for r in long]) > 0.7
