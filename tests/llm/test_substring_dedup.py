import random
import re

import pytest

from newsloom.llm import substring_dedup as S

SCHEMA = "doc_id long, text string, unit int, kept string, bucket int"


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def plain(rows):
    first = {}
    key = lambda i, a: ((i is None, i or 0), a)
    for i, t, *_ in rows:
        ws = words(t)
        for a in range(len(ws) - 19):
            k = tuple(ws[a : a + 20])
            first[k] = min(first.get(k, key(i, a)), key(i, a))
    out = []
    for i, t, *_ in rows:
        ws = words(t)
        gone = set()
        for a in range(len(ws) - 19):
            if key(i, a) > first[tuple(ws[a : a + 20])]:
                gone.update(range(a, a + 20))
        spans = []
        for n in sorted(gone):
            if spans and spans[-1][1] == n:
                spans[-1][1] = n + 1
            else:
                spans.append([n, n + 1])
        out.append((i, len(ws), len(gone), [tuple(s) for s in spans], " ".join(w for n, w in enumerate(ws) if n not in gone)))
    return out


def made(seed):
    rng = random.Random(seed)
    fresh = lambda n: [rng.choice(["é", "a", "the"]) if rng.random() < 0.3 else f"w{rng.randrange(5000)}" for _ in range(n)]
    passages = [fresh(n) for n in (19, 20, 21, 29, 30, 39, 40, 55, 120)]
    rows = []
    for i in range(150):
        ws = fresh(rng.randrange(40))
        for _ in range(rng.randrange(3)):
            p = rng.choice(passages)
            a = rng.randrange(len(p))
            ws += rng.choice([p, p[a:], p[:a]]) + fresh(rng.randrange(25))
        rows.append((i, "".join(w + rng.choice([" ", "\n", "\t", "  ", "\r\n\x0b"]) for w in ws).strip() if i % 2 else " ".join(ws), 0, "", 0))
    rows += [(200 + i, " ".join(passages[-1]), 0, "", 0) for i in range(30)]
    rows += [(300, "again " * 3000, 0, "", 0), (301, "x again " + "again " * 30 + "y", 0, "", 0), (302, "a b c " * 20_000, 0, "", 0)]
    rows += [(400, None, 0, "", 0), (401, "", 0, "", 0), (402, " \n", 0, "", 0), (403, "long" * 100_000, 0, "", 0)]
    rows += [rows[3], rows[3], (rows[4][0], " ".join(fresh(7) + passages[-2]), 0, "", 0)]
    rows += [(None, " ".join(passages[-1] + fresh(5)), 0, "", 0), (None, None, 0, "", 0), (-5, " ".join(fresh(3) + passages[-1][:60]), 0, "", 0)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed, unit_bytes", [(1, 8 << 20), (2, 2000)])
def test_against_all_windows(spark, seed, unit_bytes, monkeypatch):
    monkeypatch.setattr(S, "UNIT_BYTES", unit_bytes)
    monkeypatch.setattr("newsloom.llm.units.LEAST", 4)
    rows = made(seed)
    got = S.repeated_passages(spark.createDataFrame(rows, SCHEMA)).collect()
    found = sorted(((r.doc_id, r.n_words, r.n_removed, [tuple(s) for s in r.spans], r.kept) for r in got), key=str)
    expected = sorted(plain(rows), key=str)
    assert found == expected and sum(e[2] for e in expected) > 5000


def test_false_hits_change_nothing(spark, monkeypatch):
    monkeypatch.setattr(S, "BLOCK_BITS", 3)
    monkeypatch.setattr("newsloom.llm.units.LEAST", 2)
    rows = made(3)[:60]
    got = S.repeated_passages(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted((str(r.doc_id), r.kept) for r in got) == sorted((str(e[0]), e[4]) for e in plain(rows))


def test_empty(spark, monkeypatch):
    monkeypatch.setattr("newsloom.llm.units.LEAST", 2)
    assert S.repeated_passages(spark.createDataFrame([], SCHEMA)).collect() == []
