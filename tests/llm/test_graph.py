import random

from conftest import values

from tablesync.llm.graph import components


def test_components_of_chains_stars_and_noise(rows):
    rng = random.Random(2)
    edges = [(k, k + 1) for k in range(300)] + [(1000, 1000 + k) for k in range(1, 400)] + [(5000, 5000), (7001, 7000), (7000, 7001)]
    edges += [(2000 + rng.randrange(200), 2000 + rng.randrange(200)) for _ in range(150)]
    up = {}

    def root(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for a, b in edges:
        if a != b:
            x, y = root(a), root(b)
            up[max(x, y)] = min(x, y)
    rng.shuffle(edges)
    assert values(components(rows(edges, "a long, b long"))) == values(rows([(x, root(x)) for x in up], "a long, b long"))


def test_no_edges(rows):
    assert components(rows([], "a binary, b binary")).count() == 0
