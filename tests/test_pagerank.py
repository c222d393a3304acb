"""PageRank against a dense matrix."""

import numpy as np
import pytest

from pagequarry.operators import pagerank as pr, spread as sp
from pagequarry.session import Workspace


def dense(edges, nodes, rounds=20, damping=0.9, dangling="drop"):
    names = sorted(set(nodes) | {e[0] for e in edges} | {e[1] for e in edges})
    place = {name: i for i, name in enumerate(names)}
    n = len(names)
    links = np.zeros((n, n))
    for s, d, w in edges:
        links[place[s], place[d]] += w
    step = np.zeros((n, n))
    for i in range(n):
        total = links[i].sum()
        if total:
            step[i] = damping * links[i] / total + (1 - damping) / n
        elif dangling == "uniform":
            step[i] = 1 / n
    rank = np.full(n, 1 / n)
    for _ in range(rounds):
        rank = rank @ step
    return dict(zip(names, rank))


GRAPHS = {
    "two_cycle": ([("a", "b", 1), ("b", "a", 1)], []),
    "chain": ([("a", "b", 1), ("b", "c", 1)], []),
    "self_loop": ([("a", "a", 1), ("a", "b", 1), ("b", "a", 2)], []),
    "weights": ([("a", "b", 3), ("a", "c", 1), ("b", "a", 1), ("c", "a", 1)], ["lonely"]),
}


@pytest.mark.parametrize("name", GRAPHS)
@pytest.mark.parametrize("dangling", ["drop", "uniform"])
def test_small_graphs(spark, name, dangling):
    edges, nodes = GRAPHS[name]
    df = spark.createDataFrame(edges, "src string, dst string, weight long")
    extra = spark.createDataFrame([(n,) for n in nodes], "url string")
    got = pr.pagerank(df, Workspace(spark), extra, rounds=4, dangling=dangling).collect()
    expected = dense(edges, nodes, 4, dangling=dangling)
    assert {r.url: pytest.approx(r.rank, abs=1e-12) for r in got} == expected
    assert sum(r.rank for r in got) <= 1 + 1e-9


def test_hub_that_links_to_a_third(spark):
    edges = [("hub", f"n{i}", 1) for i in range(100)] + [(f"n{i}", f"n{(i * 3) % 100}", 1) for i in range(100)]
    edges += [(f"n{i}", "hub", 2) for i in range(100)]
    df = spark.createDataFrame(edges, "src string, dst string, weight long")
    assert sp.hot_keys(df, ["src"]).where("src = 'hub' AND _salts > 10").count() == 1
    got = {r.url: r.rank for r in pr.pagerank(df, Workspace(spark), rounds=3).collect()}
    expected = dense(edges, [], 3)
    assert got.keys() == expected.keys()
    assert all(abs(got[u] - expected[u]) < 1e-12 for u in got)


def test_no_edges(spark):
    df = spark.createDataFrame([], "src string, dst string, weight long")
    assert pr.pagerank(df, Workspace(spark), rounds=2).count() == 0
