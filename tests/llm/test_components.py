"""Components: tasks merge their own edges, and the rounds end when the edges are stars."""

import numpy as np
import pytest

from linkstats.llm import components as cc


def smallest(edges):
    root = {}
    for a, b in edges:
        for x in (a, b):
            root.setdefault(x, x)
    moved = True
    while moved:
        moved = False
        for a, b in edges:
            low = min(root[a], root[b])
            moved = moved or root[a] != low or root[b] != low
            root[a] = root[b] = low
    return root


def test_merged_edges_are_stars_of_the_smallest_nodes():
    rng = np.random.default_rng(5)
    for _ in range(100):
        a, b = rng.integers(-20, 20, (2, rng.integers(0, 40)))
        want = {k: v for k, v in smallest(list(zip(a.tolist(), b.tolist()))).items() if k != v}
        high, low = cc.merged(a, b)
        assert dict(zip(high.tolist(), low.tolist())) == want and len(high) == len(want)


@pytest.mark.parametrize("limit, block", [(None, None), ("0", 3)])
def test_components_over_several_tasks(spark, monkeypatch, limit, block):
    if block:
        monkeypatch.setattr(cc, "EDGES", block)
    if limit:
        spark.conf.set("linkstats.broadcast.maxBytes", limit)
    try:
        rng = np.random.default_rng(6)
        path = [(i, i + 1) for i in range(100, 160)]
        hub = [(500, i) for i in range(501, 560)] + [(501, 500)] * 3
        loose = [(int(a), int(b)) for a, b in rng.integers(1000, 1080, (50, 2))]
        edges = [(a, b) for a, b in path + hub + loose]
        rng.shuffle(edges)
        got = cc.components(spark.createDataFrame([(int(a), int(b)) for a, b in edges] + [(7, 7)], "a long, b long").repartition(5)).collect()
        linked = {x for a, b in edges if a != b for x in (a, b)}
        assert len(got) == len(linked)
        assert {r["node"]: r["component"] for r in got} == {k: v for k, v in smallest(edges).items() if k in linked}
    finally:
        spark.conf.unset("linkstats.broadcast.maxBytes")


def test_edges_of_one_task_need_no_round(spark, monkeypatch):
    rounds = []
    star = cc._star
    monkeypatch.setattr(cc, "_star", lambda *a: rounds.append(1) or star(*a))
    path = spark.createDataFrame([(i, i + 1) for i in range(200)], "a long, b long").coalesce(1)
    assert {r["component"] for r in cc.components(path).collect()} == {0} and not rounds
    empty = cc.components(path.where("a < 0"))
    assert empty.count() == 0


def test_a_node_in_the_edges_of_many_files_comes_out_once(spark, monkeypatch):
    given, local = [], cc._local

    def counted(*a):
        given.append(local(*a))
        return given[-1]
    monkeypatch.setattr(cc, "_local", counted)
    rng = np.random.default_rng(7)
    orders = [rng.permutation(40) for _ in range(30)]  # each file links all nodes, in another order
    edges = spark.createDataFrame([(f, int(a), int(b)) for f, o in enumerate(orders) for a, b in zip(o, o[1:])], "f int, a long, b long")
    got = cc.components(edges.repartition(30, "f").select("a", "b")).collect()
    assert sorted(r["node"] for r in got) == list(range(40)) and {r["component"] for r in got} == {0}
    assert sum(x.count() for x in given) == 39
