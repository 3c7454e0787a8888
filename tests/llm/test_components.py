import random

import pytest

from tessera.llm.components import _large_star, _small_star, connected_components


def smallest(edges):
    """Per node the smallest that it hangs together with."""
    root = {x: x for e in edges for x in e if e[0] != e[1]}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a, b in edges:
        if a != b:
            low, high = sorted((find(a), find(b)))
            root[high] = low
    return {x: find(x) for x in root}


def test_stars_take_no_round_and_paths_some(spark):
    def labels(edges, **limit):
        return {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long"), **limit).collect()}

    stars = [(1, k) for k in range(2, 30)] + [(k, 40) for k in range(41, 50)] + [(7, 7), (2, 1)]
    assert labels(stars, max_rounds=0) == smallest(stars)
    assert labels([(3, 3)], max_rounds=0) == {}
    path = [(k, k + 1) for k in range(40)]
    assert labels(path) == smallest(path)
    with pytest.raises(RuntimeError, match="settle in 1 rounds"):
        labels(path, max_rounds=1)
    draw = random.Random(5)
    for n in (30, 60, 120):
        edges = [(draw.randrange(100), draw.randrange(100)) for _ in range(n)]
        assert labels(edges) == smallest(edges)


def test_a_round_deals_no_table_out_twice_over(spark):
    """Every shuffle leaves files in all tasks of the stage before it; a union has the tasks of both sides."""
    star = spark.createDataFrame([(k, k // 2) for k in range(1, 9)], "u long, v long").checkpoint()
    plan = _small_star(_large_star(star))._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" not in plan
    assert plan.count("Aggregate") <= 4  # the large star's stands under both sides of the small star's join
