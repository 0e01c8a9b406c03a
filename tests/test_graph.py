"""Walks to a fixed point against plain searches."""

import random
from collections import deque

import pytest

from clausemill.operators import graph as G

EDGES = "src_clause_id long, dst_clause_id long"


def shortest(edges, start):
    """node -> the first of its shortest paths, by ids."""
    out, queue = {start: [start]}, deque([start])
    while queue:
        level = sorted(queue, key=lambda n: out[n])
        queue = deque()
        for n in level:
            for m in sorted(edges.get(n, ())):
                if m not in out:
                    out[m] = [*out[n], m]
                    queue.append(m)
    return out


def graph_of(seed, nodes, n):
    rng = random.Random(seed)
    rows = [(rng.randrange(nodes), rng.randrange(nodes)) for _ in range(n)]
    return [*rows, *rows[:3], (None, 1), (1, None)]


def table_of(rows):
    out = {}
    for a, b in rows:
        if a is not None and b is not None:
            out.setdefault(a, set()).add(b)
    return out


def test_closure_with_paths(spark):
    rows = graph_of(1, 40, 60)
    rows += [(k, k + 1) for k in range(100, 112)] + [(112, 100)]  # a long cycle
    edges, starts = table_of(rows), [0, 3, 7, 100, 999, 3]
    found = G.closure(spark.createDataFrame(rows, EDGES), spark.createDataFrame([(s,) for s in [*starts, None]], "clause_id long"))
    want = {(s, n): p for s in set(starts) for n, p in shortest(edges, s).items()}
    got = {(r["start_id"], r["node_id"]): r["path"] for r in found.collect()}
    assert got == want and found.where("size(path) <> hops + 1").count() == 0
    assert max(map(len, want.values())) == 13
    plan = found._jdf.queryExecution().toString()
    assert "Join" not in plan  # what comes back is a table, however many rounds it took


@pytest.mark.parametrize("seed,nodes,n", [(2, 30, 45), (3, 60, 60), (4, 12, 60)])
def test_cycles_against_reach(spark, seed, nodes, n):
    rows = graph_of(seed, nodes, n)
    edges = table_of(rows)
    far = {a: {m for b in edges[a] for m in shortest(edges, b)} for a in edges}
    want = set()
    for a in far:
        same = {b for b in far[a] if a in far.get(b, ())}
        if same:
            want.add((a, min(same), len(same)))
    assert {tuple(r) for r in G.cycles(spark.createDataFrame(rows, EDGES)).collect()} == want and want


def test_nothing_and_chains(spark):
    none = spark.createDataFrame([], EDGES)
    assert G.cycles(none).count() == 0
    assert G.closure(none, spark.createDataFrame([(5,)], "clause_id long")).collect()[0]["path"] == [5]
    chain = spark.createDataFrame([(k, k + 1) for k in range(6)] + [(9, 9)], EDGES)
    assert [tuple(r) for r in G.cycles(chain).collect()] == [(9, 9, 1)]
    assert G.closure(chain, chain.limit(0).withColumnRenamed("src_clause_id", "clause_id")).count() == 0
