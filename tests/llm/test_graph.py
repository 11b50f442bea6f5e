import random

from brambler.llm.graph import components


def brute(edges):
    label = {v: v for e in edges for v in e}
    moved = True
    while moved:
        moved = False
        for a, b in edges:
            low = min(label[a], label[b])
            moved |= label[a] != low or label[b] != low
            label[a] = label[b] = low
    return {v: c for v, c in label.items() if any(v in e and e[0] != e[1] for e in edges)}


def test_components(spark):
    rng = random.Random(4)
    chain = list(range(1000, 1060))
    rng.shuffle(chain)
    edges = [(a, b) for a, b in zip(chain, chain[1:])]  # noqa: B905
    edges += [(rng.randint(0, 80), rng.randint(0, 80)) for _ in range(45)] + [(5, 5), (2000, 2001), (2001, 2000), (2000, 2001)]
    edges += [(-(2**62), 2**62)] + [(3000, 3000 + i) for i in range(1, 200)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == brute(edges)


def test_no_edges(spark):
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
