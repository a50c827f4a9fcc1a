"""Components and projects against plain union-find."""

import random

import pytest

from rollcall.operators import components, projects
from rollcall.session import clean


def groups_of(edges):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in edges:
        parent[find(a)] = find(b)
    found = {}
    for v in list(parent):
        found.setdefault(find(v), set()).add(v)
    return {frozenset(g) for g in found.values()}


def labelled(spark, edges):
    frame = spark.createDataFrame(edges, "a string, b string")
    found = {}
    for row in components.component_labels(frame).collect():
        found.setdefault(row.label, set()).add(row.vertex)
    return {frozenset(g) for g in found.values()}


random.seed(7)
GRAPHS = {
    "chain": [(f"v{i:03d}", f"v{i + 1:03d}") for i in range(64)],
    "star": [("hub", f"leaf{i}") for i in range(500)],
    "two stars with a bridge": [("a", f"x{i}") for i in range(50)]
    + [("b", f"y{i}") for i in range(60)] + [("x1", "y1")],
    "random": [(f"n{random.randrange(400)}", f"n{random.randrange(400)}") for _ in range(300)],
}


@pytest.mark.parametrize("name", GRAPHS)
@pytest.mark.parametrize("share", [0.0, 0.3, 0.97, 1.0])
def test_more_edges_give_the_labels_of_all(spark, name, share):
    edges = list(GRAPHS[name])
    random.Random(1).shuffle(edges)
    cut = int(len(edges) * share)
    old, new, both = (spark.createDataFrame(e, "a string, b string") for e in (
        edges[:cut], edges[cut:] + edges[:2] + [("self", "self"), (None, "x")], edges))
    labels = components.component_labels(old)
    got = components.extended_labels(labels, new)
    assert sorted(map(tuple, got.collect())) == \
        sorted(map(tuple, components.component_labels(both).collect()))


@pytest.mark.parametrize("name", GRAPHS)
def test_components(spark, name):
    edges = GRAPHS[name]
    wanted = {g for g in groups_of(edges) if len(g) > 1}
    assert labelled(spark, edges) == wanted


def test_large_chain_and_star(spark):
    """Graphs of more edges than one short job handles at a time."""
    star = spark.range(1, 150_000).selectExpr("'hub' AS a", "concat('leaf', id) AS b")
    chain = spark.range(3000).selectExpr("lpad(id, 5, '0') AS a", "lpad(id + 1, 5, '0') AS b")
    labels = components.component_labels(star.union(chain))
    assert sorted(tuple(r) for r in labels.groupBy("label").count().collect()) == \
        [("00000", 3001), ("hub", 150_000)]
    assert clean(spark) > 0


def test_no_edges(spark):
    assert labelled(spark, [("a", "a")]) == set()


AGENTS = [
    # agent, owner, domain: a and b share an owner, b and c a domain
    ("a", "O1", None), ("b", "o1", "d1.test"), ("c", "o3", "D1.test"), ("d", "o4", "ipfs.io"),
    ("e", "o5", "ipfs.io"), ("f", "", None), ("g", None, "x.vercel.app"), ("h", None, "d9.test"),
    ("i", "", "d9.test")]


def test_projects(spark):
    frame = spark.createDataFrame(AGENTS, "agent_id string, owner string, uri_root_domain string")
    found = {}
    for row in projects.with_project(frame).collect():
        found.setdefault(row.project, set()).add(row.agent_id)
    assert {frozenset(g) for g in found.values()} == {
        frozenset(g) for g in ("abc", "d", "e", "f", "g", "hi")}


def test_top_projects(spark):
    frame = spark.createDataFrame(
        [(a, o, d, a in "ab") for a, o, d in AGENTS],
        "agent_id string, owner string, uri_root_domain string, live_strict boolean")
    top = projects.top_projects(projects.with_project(frame), 4).collect()
    assert [(r.agents, r.owners, r.label, r.live_agents) for r in top] == [
        (3, 2, "D1.test", 2), (2, 0, "d9.test", 0), (1, 1, "1 wallet(s) on ipfs.io", 0),
        (1, 1, "1 wallet(s) on ipfs.io", 0)]
