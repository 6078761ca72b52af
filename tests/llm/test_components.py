import random

import pytest

from docmill.llm.components import connected_components


def solved(spark, edges, watch=None):
    df = spark.createDataFrame(edges, "a long, b long").repartition(4)
    return {r["node"]: r["component"] for r in connected_components(df, watch=watch).collect()}


def test_no_edges_nulls_loops_and_repeats(spark):
    assert solved(spark, []) == {}
    assert solved(spark, [(1, 1), (None, 2), (3, None)]) == {}
    assert solved(spark, [(5, 2), (2, 5), (5, 2), (7, 7), (-4, 2)]) == {5: -4, 2: -4, -4: -4}


@pytest.mark.parametrize("shuffled", [False, True])
def test_chain_of_five_thousand(spark, shuffled):
    names = list(range(5000))
    if shuffled:
        random.Random(1).shuffle(names)
    rounds: list[int] = []
    assert solved(spark, list(zip(names, names[1:])), rounds) == {i: 0 for i in range(5000)}
    assert len(rounds) <= 13 and sum(rounds) <= 26


@pytest.mark.parametrize("centre", [0, 50_000, 100_000])
def test_star(spark, centre):
    rounds: list[int] = []
    got = solved(spark, [(centre, i) for i in range(100_001) if i != centre], rounds)
    assert len(got) == 100_001 and set(got.values()) == {0} and len(rounds) <= 2


def test_random_graph_matches_union_find(spark):
    rng = random.Random(7)
    edges = [(rng.randrange(3000), rng.randrange(3000)) for _ in range(1700)]
    root = list(range(3000))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    rounds: list[int] = []
    got = solved(spark, edges, rounds)
    assert got == {x: find(x) for a, b in edges if a != b for x in (a, b)} and len(rounds) <= 12
