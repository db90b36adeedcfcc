"""The walk rule on chains, cycles, self-loops, tails and duplicates."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from conftest import rows
from linkstats.operators import redirects as rd


def walk(m, s):
    """The rule as a plain recursive function over a dict."""
    def go(uri, seen):
        if uri not in m:
            return uri
        nxt = m[uri]
        return nxt if nxt in seen else go(nxt, seen | {nxt})
    return go(s, frozenset())


def edges_df(spark, edges):
    return spark.createDataFrame(edges, "src string, dst string")


def test_fixture_graph(spark):
    edges = [("a", "b"), ("b", "c"),            # chain -> c
             ("x", "y"), ("y", "x"),            # 2-cycle
             ("s", "s"),                        # self-loop
             ("t", "p"), ("p", "q"), ("q", "r"), ("r", "p"),  # tail into a 3-cycle
             ("d", "z"), ("d", "c")]            # duplicate title: smallest target wins
    got = dict(rows(rd.resolve(edges_df(spark, edges)), "title", "final"))
    m = {}
    for s, d in sorted(edges, key=lambda e: (e[0], e[1]), reverse=True):
        m[s] = d  # smallest dst last
    assert got == {s: walk(m, s) for s in m}
    assert got["a"] == "c" and got["b"] == "c"
    assert got["x"] == "y" and got["y"] == "x"
    assert got["s"] == "s"
    assert got["t"] == "p" and got["p"] == "q"
    assert got["d"] == "c"


def test_final_first_orientation(spark):
    got = rows(rd.resolve_final_first(edges_df(spark, [("BRD", "Deutschland"), ("Deutschland", "Germany")])))
    assert got == [("Germany", "BRD"), ("Germany", "Deutschland")]


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.dictionaries(st.integers(0, 12), st.integers(0, 15), min_size=1, max_size=13))
def test_random_functional_graphs(spark, graph):
    m = {str(k): str(v) for k, v in graph.items()}
    got = dict(rows(rd.resolve(edges_df(spark, list(m.items()))), "title", "final"))
    assert got == {s: walk(m, s) for s in m}


def test_resolve_targets_exact_then_folded(spark):
    resolved = spark.createDataFrame([("Berlin", "Berlin_City"), ("berlin", "Berlin_Lower"), ("BERLIN", "A_Berlin")],
                                     "title string, final string")
    links = spark.createDataFrame([("Berlin",), ("BeRLiN",), ("Paris",)], "uri string")
    got = dict(rows(rd.resolve_targets(links, resolved), "uri", "target"))
    assert got == {"Berlin": "Berlin_City", "BeRLiN": "A_Berlin", "Paris": "Paris"}


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.dictionaries(st.integers(0, 12), st.integers(0, 15), min_size=1, max_size=13))
def test_doubling_equals_walk_rule(spark, graph):
    m = {str(k): str(v) for k, v in graph.items()}
    got = dict(rows(rd.resolve(edges_df(spark, list(m.items()))), "title", "final"))
    assert got == {s: walk(m, s) for s in m}


def test_doubling_long_chain_and_fixture(spark):
    chain = [(str(i), str(i + 1)) for i in range(200)] + [("x", "y"), ("y", "x"), ("s", "s"),
                                                          ("t", "p"), ("p", "q"), ("q", "r"), ("r", "p")]
    m = dict(chain)
    got = dict(rows(rd.resolve(edges_df(spark, chain)), "title", "final"))
    assert got == {s: walk(m, s) for s in m}
    assert got["0"] == "200"
