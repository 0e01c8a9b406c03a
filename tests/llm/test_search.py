import numpy as np
import pytest
from pyspark.sql import functions as F

from clausemill.llm import components, topk, vectors
from clausemill.llm._shared import Scratch


def brute(ids, rows, k):
    out = []
    for q, (i, v) in enumerate(zip(ids, rows, strict=True)):
        scores = sorted((-int(v @ w), j) for p, (j, w) in enumerate(zip(ids, rows, strict=True)) if p != q)[:k]
        out += [(i, r, j, -s) for r, (s, j) in enumerate(scores, 1)]
    return sorted(out)


@pytest.mark.parametrize("spread", [1, 3, 1000, 2**28, 2**40])
def test_blocks(spread):
    rng = np.random.default_rng(spread)
    rows = rng.integers(-spread, spread + 1, (300, 6))
    ids = np.concatenate([rng.permutation(1000)[:280], np.full(20, 5)])  # an id may have several rows
    who, where, best, scored = topk.Blocks(np.arange(300), ids, rows, 16).search(np.arange(300), rows, 5)
    got = sorted((int(ids[q]), 1 + k % 5, int(i), int(s)) for k, (q, i, s) in enumerate(zip(who, where, best, strict=True)))
    assert got == brute(ids.tolist(), rows.astype(object) if spread > 1e6 else rows, 5) and scored.sum() <= 300 * 300


def clustered(n, seed, dim=32):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n // 50, dim))[rng.integers(0, n // 50, n)] + 0.15 * rng.normal(size=(n, dim))
    return np.floor(256 * x / np.linalg.norm(x, axis=1, keepdims=True)).astype(int)


def test_like_rows_share_blocks():
    rows = clustered(2000, 3)
    _, _, _, scored = topk.Blocks(np.arange(2000), np.arange(2000), rows, 32).search(np.arange(200), rows[:200], 5)
    assert scored.sum() < 0.25 * 200 * 2000


def test_search_prunes(spark):
    rows = clustered(6000, 4)
    df = spark.createDataFrame([(i, (v / 256).tolist()) for i, v in enumerate(rows)], "vec_id long, embedding array<double>")
    held = Scratch(spark, "t").keep(topk.integer_vectors(df), "vectors")
    out = topk.top_k(held, held.where("id % 50 = 0"), 5, shard_rows=1000, part_rows=2000, query_rows=40, seed_rows=256).collect()
    assert len(out) == 5 * 120
    for q in (0, 50, 5950):
        scores = sorted((-int(rows[q] @ w), i) for i, w in enumerate(rows) if i != q)[:5]
        assert [(r["vec_id"], r["score"]) for r in sorted((r for r in out if r["query_id"] == q), key=lambda r: r["rank"])] == [(i, -s) for s, i in scores]
    assert sum(r["scored"] for r in out if r["rank"] == 1) < 0.5 * 120 * 6000


EDGE = [(1, [1.0, 0.0]), (2, [0.5, 0.5]), (3, None), (4, [float("nan"), 1.0]), (5, [float("inf"), 1.0]), (6, [None, 1.0]), (7, [0.0, 0.0]), (8, []), (9, [1.0]), (2, [0.5, 0.5]), (None, [1.0, 1.0]), (10, [1.0, 0.0])]


def test_search_edges(spark):
    df = spark.createDataFrame([(i, v, "x") for i, v in EDGE], "vec_id long, embedding array<float>, id string")
    rows = Scratch(spark, "t").keep(topk.integer_vectors(df), "vectors")
    got = topk.top_k(rows, rows, 2, shard_rows=3, block_rows=2, query_rows=4).collect()
    first = {r["query_id"]: (r["vec_id"], r["score"]) for r in got if r["rank"] == 1}
    assert first[1] == (9, 65536) and first[9] == (1, 65536) and first[8] == (1, 0) and set(first) == {1, 2, 7, 8, 9, 10}
    # Rows of a repeated id are queries and candidates of their own; each is most like the first rows, then like the other.
    assert sorted((r["rank"], r["vec_id"]) for r in got if r["query_id"] == 2) == [(1, 1), (1, 1), (2, 2), (2, 2)]
    assert topk.top_k(rows.limit(0), rows.limit(0)).count() == 0 and topk.top_k(rows.where("id = 1"), rows.where("id = 1")).count() == 0


def test_scores_beyond_64_bits(spark):
    big = [(1, [1e300]), (2, [2e300]), (3, [-1e300]), (4, [1e9]), (5, [2e9]), (6, [-3e9])]
    rows = Scratch(spark, "t").keep(topk.integer_vectors(spark.createDataFrame(big, "vec_id long, embedding array<double>")), "vectors")
    got = {(r["query_id"], r["rank"]): (r["vec_id"], r["score"]) for r in topk.top_k(rows, rows, 5).collect()}
    most, least = 2**63 - 1, -(2**63)
    assert [got[1, k][0] for k in range(1, 6)] == [2, 5, 4, 6, 3] and got[1, 1][1] == most and got[1, 5][1] == least
    assert [got[6, k][0] for k in range(1, 6)] == [3, 4, 5, 1, 2] and got[6, 1][1] == most
    assert got[4, 1] == (1, most) and got[4, 3] == (5, 256 * 10**9 * 512 * 10**9 if 256 * 10**9 * 512 * 10**9 <= most else most)


def test_components(spark):
    rng = np.random.default_rng(5)
    pairs = [(int(a), int(b)) for a, b in rng.integers(0, 300, (180, 2))] + [(1000 + k, 1001 + k) for k in range(40)] + [(7, 7)]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in pairs:
        if a != b:
            a, b = sorted((find(a), find(b)))
            parent[b] = a
    df = spark.createDataFrame(pairs, "a long, b long")
    got = {r["id"]: r["component_id"] for r in components.components(df, Scratch(spark, "t")).collect()}
    assert got == {x: find(x) for x in list(parent) if sum(find(y) == find(x) for y in parent) > 1}
    assert components.components(df.limit(0), Scratch(spark, "t")).count() == 0


def check(df, **o):
    got = {r["vec_id"]: r for r in vectors.near_duplicates(df, **o).collect()}
    rows = {r["vec_id"]: r["embedding"] for r in df.collect()}
    ok = {i: np.array(v, float) for i, v in rows.items() if v and all(x is not None and np.isfinite(x) for x in v) and any(v)}
    links = {i: {j for j, w in ok.items() if j != i and v @ w / (np.linalg.norm(v) * np.linalg.norm(w)) >= 0.9} for i, v in ok.items()}
    return got, rows, links


@pytest.mark.parametrize("o", [{}, {"cell_rows": 8, "reach": 1.0}, {"cell_rows": 8, "reach": 1.0, "block_rows": 16}, {"cell_rows": 8}, {"cell_rows": 4, "reach": 1.0, "most_cells": 3, "most_parts": 8}, {"cell_rows": 4, "reach": 1.0, "most_cells": 4, "block_rows": 9}])
def test_near_vectors(spark, o):
    rng = np.random.default_rng(1)
    base = rng.normal(size=(40, 12))
    x = np.concatenate([base, base[:20] + 0.15 * rng.normal(size=(20, 12)), base[:5], np.repeat(base[:1], 30, 0) + 0.05 * rng.normal(size=(30, 12))])
    df = spark.createDataFrame([(int(i), v.tolist(), 0) for i, v in zip(rng.permutation(500), x, strict=False)], "vec_id long, embedding array<double>, kept int")
    got, rows, links = check(df.drop("kept"), **o)
    total = sum(map(len, links.values()))
    assert total > 900 and sum(r["n_links"] for r in got.values()) >= 0.99 * total
    for i, r in got.items():
        assert r["n_links"] <= len(links[i]) and r["kept"] == (r["component_id"] == i)
    if o.get("reach") == 1.0 or not o:
        for i, r in got.items():
            seen, todo = {i}, [i]
            while todo:
                new = links[todo.pop()] - seen
                seen |= new
                todo += new
            assert r["component_id"] == min(seen) and r["n_links"] == len(links[i])


@pytest.mark.parametrize("o", [{}, {"most_cells": 16}])
def test_recall_close_above_the_least_cosine(spark, o):
    """Pairs at cosines of 0.90 to 0.92 in 64 dimensions, among vectors of no structure."""
    rng = np.random.default_rng(9)
    a = rng.normal(size=(1500, 64))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    side = rng.normal(size=a.shape)
    side -= (side * a).sum(1, keepdims=True) * a
    side /= np.linalg.norm(side, axis=1, keepdims=True)
    cosine = rng.uniform(0.901, 0.92, (len(a), 1))
    x = np.concatenate([a, cosine * a + np.sqrt(1 - cosine**2) * side, rng.normal(size=(3000, 64))])
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    u = vectors.unit(x)
    want = int((u @ u.T >= 0.9).sum()) - len(u)
    found = vectors.near_duplicates(df, cell_rows=16, **o).agg(F.sum("n_links")).first()[0]
    assert 0.97 * want <= found <= want and want >= 3000


def test_clashing_names_of_vectors(spark):
    df = spark.createDataFrame([(1, [1.0], "a", "b", "c", 7)], "vec_id long, embedding array<double>, n_links string, component_id string, kept string, id int")
    out = vectors.near_duplicates(df)
    assert out.columns == ["vec_id", "embedding", "id", "n_links", "component_id", "kept"] and out.first()["kept"] is True


def test_near_vector_edges(spark):
    df = spark.createDataFrame([(i, v, "z") for i, v in EDGE], "vec_id long, embedding array<float>, n_links string")
    out = vectors.near_duplicates(df.withColumnRenamed("n_links", "label"))
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in out.where("vec_id IS NOT NULL").collect()}
    assert got[1] == (2, 1) and got[9] == (2, 1) and got[10] == (2, 1) and all(got[i] == (0, i) for i in (2, 3, 4, 5, 6, 7, 8)) and out.count() == len(EDGE)
    assert vectors.near_duplicates(df.limit(0)).count() == 0


def test_reach_is_widened_where_links_need_it(spark):
    rng = np.random.default_rng(12)
    x = np.zeros((2000, 32))
    x[:, :3] = rng.normal(size=(2000, 3))  # few effective dimensions: differences lie along those between centroids
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    u = vectors.unit(x)
    want = int((u @ u.T >= 0.99).sum()) - len(u)
    got = {k: vectors.near_duplicates(df, least=0.99, cell_rows=8, probes=n).agg(F.sum("n_links")).first()[0] for k, n in (("fixed", 0), ("widened", 512))}
    assert got["fixed"] < 0.99 * want and 0.995 * want <= got["widened"] <= want


@pytest.mark.parametrize("kind", ["float", "double"])
def test_parts_with_many_visitors_are_not_split(spark, monkeypatch, kind):
    """Nearly all vectors visit every part, but only those at home there are compared with them."""
    rng = np.random.default_rng(21)
    x = rng.normal(size=(3000, 16)).astype(np.float32)
    x[1000:1400] = x[:400] + np.float32(0.08) * rng.normal(size=(400, 16)).astype(np.float32)
    kept, keep = {}, Scratch.keep

    def seen(self, df, name, *by):
        kept[name] = keep(self, df, name, *by)
        return kept[name]

    monkeypatch.setattr(Scratch, "keep", seen)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], f"vec_id long, embedding array<{kind}>")
    got = vectors.near_duplicates(df, reach=1.0, block_rows=256).select("vec_id", "n_links").collect()
    y = x.astype(np.float64)
    linked = (y @ y.T) / np.outer(np.linalg.norm(y, axis=1), np.linalg.norm(y, axis=1)) >= 0.9
    want = linked.sum(1) - 1
    assert want.sum() >= 800 and all(r["n_links"] == want[r["vec_id"]] for r in got)
    assert kept["split"].count() == 0
