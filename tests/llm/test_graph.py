import random
from pathlib import Path

import pytest

from lendlake.llm import graph
from lendlake.session import checkpoint_dir


def union_find(edges):
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            root[x] = x = root[root[x]]
        return x

    for a, b in edges:
        if a is not None and b is not None and a != b:
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    return {x: find(x) for x in root}


def result(spark, edges, rounds=None):
    df = spark.createDataFrame(edges, "a long, b long")
    rows = graph.components(df, (rounds if rounds is not None else []).append).collect()
    got = {r.node: r.root for r in rows}
    assert len(got) == len(rows)
    return got


@pytest.mark.parametrize("order", ["ascending", "descending", "random"])
def test_chains_in_few_rounds(spark, order):
    ids = list(range(2000))
    if order == "random":
        random.Random(1).shuffle(ids)
    chain = list(zip(ids, ids[1:]))
    rounds = []
    got = result(spark, chain[::-1] if order == "descending" else chain, rounds)
    assert got == dict.fromkeys(range(2000), 0)
    assert len(rounds) <= 15


def test_random_graphs_cliques_and_awkward_pairs(spark):
    r = random.Random(2)
    edges = [(r.randrange(600), r.randrange(600)) for _ in range(400)]
    edges += [(a, b) for a in range(700, 720) for b in range(700, 720)]  # a clique, with loops and both directions
    edges += [(None, 3), (4, None), (None, None), (5, 5), (-7, 2**62), (-7, 2**62)]
    assert result(spark, edges) == union_find(edges)


def test_stars_need_no_round_and_nothing_is_left_behind(spark):
    top = Path(checkpoint_dir(spark).removeprefix("file:"))
    before = set(top.glob("llm-components-*"))
    rounds = []
    assert len(result(spark, [(1, k) for k in range(2, 400)], rounds)) == 399 and rounds == []
    assert result(spark, []) == {}
    result(spark, [(400, k) for k in range(0, 800)], rounds)
    made = set(top.glob("llm-components-*")) - before
    assert len(rounds) == 1 and len(made) == 3
    assert all(len([p for p in folder.iterdir() if p.is_dir()]) == 1 for folder in made)
