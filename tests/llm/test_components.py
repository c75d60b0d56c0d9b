import random

from newsloom.llm.components import components


def plain(links):
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for u, v in links:
        u, v = find(u), find(v)
        root[max(u, v)] = min(u, v)
    return {x: find(x) for x in root}


def test_against_union_find(spark):
    rng = random.Random(3)
    links = [(i, i + 1) for i in range(100, 160)] + [(200, 200 + i) for i in range(1, 40)] + [(239, 300), (5, 5)]
    links += [(rng.randrange(400, 480), rng.randrange(400, 480)) for _ in range(45)] + [(160, 100)]
    rng.shuffle(links)
    got = components(spark.createDataFrame(links, "u long, v long")).collect()
    expected = {k: v for k, v in plain([x for x in links if x[0] != x[1]]).items()}
    assert {r.node: r.root for r in got} == expected and len(got) == len(expected)


def test_none(spark):
    assert components(spark.createDataFrame([], "u long, v long")).collect() == []
