import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given
from hypothesis import strategies as st

from clausemill.llm import mixing as M


@given(st.lists(st.tuples(st.integers(0, 1000), st.sampled_from([1, 2, 5])), min_size=1, max_size=8))
def test_targets(pairs):
    sizes, weights = [n for n, _ in pairs], [w for _, w in pairs]
    got = M.targets(sizes, weights, 1.5 * sum(sizes), 2)
    assert math.isclose(sum(got), 1.5 * sum(sizes), abs_tol=1e-6)
    assert all(t <= 2 * n + 1e-9 for t, n in zip(got, sizes, strict=True))
    free = [t / w for t, n, w in zip(got, sizes, weights, strict=True) if 0 < t < 2 * n - 1e-6]
    assert not free or max(free) - min(free) < 1e-6 * max(free)


@pytest.mark.parametrize("shards", [1, 2, 7, 64])
def test_tree(shards):
    tree = M.SplittingTree([300, 0, 41], shards, 3)
    leaves = tree.leaves()
    assert leaves.sum(0).tolist() == [300, 0, 41] and np.ptp(leaves.sum(1)) <= math.ceil(math.log2(max(2, shards))) + 1
    assert (leaves == M.SplittingTree([300, 0, 41], shards, 3).leaves()).all()


def test_tree_draws_like_a_hypergeometric_distribution():
    got = np.array([M.SplittingTree([12, 8], 2, seed).leaves()[0] for seed in range(3000)])
    # Of 20 blocks 10 go left: those of the first source have mean 6 and variance 10 * .6 * .4 * 10 / 19.
    assert (got.sum(1) == 10).all() and abs(got[:, 0].mean() - 6) < 0.1 and abs(got[:, 0].var() - 10 * 0.6 * 0.4 * 10 / 19) < 0.15


def replay(rows, weights=(5, 2, 1), block_words=64, shard_words=500, seed=17):
    """The mix by plain loops: (doc_id, text) of each row -> its draws (shard, words)."""
    md5 = lambda *x: hashlib.md5(":".join(map(str, x)).encode()).hexdigest()
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    names = sorted({s for _, _, s in rows}, key=lambda s: (s is None, s or ""))
    streams = [sorted((md5(seed, "" if d is None else d, hashlib.md5((t or "").encode()).hexdigest()), size(t), k) for k, (d, t, s) in enumerate(rows) if s == name) for name in names]
    totals = [sum(n for _, n, _ in s) for s in streams]
    quotas = [round(t) for t in M.targets(totals, [weights[i % 3] for i in range(len(names))], 1.5 * sum(totals), 2)]
    order, blocks = [], []
    for i, stream in enumerate(streams):
        held, at = {}, 0
        for _, n, k in stream * 2:
            held.setdefault(at // block_words, []).append((k, n))
            at += n
        order.append(sorted(held, key=lambda b: md5(seed, i, b)))
        blocks.append(held)
    cut = []
    for i, q in enumerate(quotas):
        got, n = [], 0
        for b in order[i]:
            if n < q:
                words = sum(m for _, m in blocks[i][b])
                got.append((b, min(words, q - n)))
                n += words
        cut.append(got)
    shards = max(1, math.ceil(sum(quotas) / shard_words))
    out, nodes = [[] for _ in rows], [(0, shards, [list(range(len(c))) for c in cut])]
    while nodes:
        lo, hi, mine = nodes.pop()
        if hi - lo > 1:
            mid = (lo + hi) // 2
            pool = sorted((md5(seed, lo, hi, i, j), i) for i, m in enumerate(mine) for j in range(len(m)))
            left = Counter(i for _, i in pool[: len(pool) * (mid - lo) // (hi - lo)])
            nodes += [(lo, mid, [m[: left[i]] for i, m in enumerate(mine)]), (mid, hi, [m[left[i] :] for i, m in enumerate(mine)])]
            continue
        for i, m in enumerate(mine):
            for j in m:
                b, room = cut[i][j]
                for k, n in blocks[i][b]:
                    if room > 0 or (n == 0 and room == 0):
                        out[k].append((lo, min(n, room)))
                    room = room - n if room - n >= 0 else -1
    return out


def plan(docs, **o):
    return M.mix_plan(docs, carry=["doc_id", "source", "size"], block_words=64, shard_words=500, **o).collect()


def test_plan(docs):
    rows = plan(docs)
    assert len(rows) == docs.count() and sorted(map(str, rows)) == sorted(map(str, plan(docs)))
    for s in {r["source"] for r in rows}:
        mine = [r for r in rows if r["source"] == s]
        taken = sum(d["words"] for r in mine for d in r["mix_draws"])
        assert abs(taken - mine[0]["mix_target"]) <= 0.5 and mine[0]["mix_source_size"] == sum(r["mix_size"] for r in mine)
    assert all(sum(d["words"] for d in r["mix_draws"]) <= 2 * r["mix_size"] for r in rows)
    assert len({d["shard"] for r in rows for d in r["mix_draws"]}) > 5


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_against_a_replay_of_the_tree(spark, seed):
    rng = random.Random(seed)
    rows = [(rng.choice([None, 5, d, d]), rng.choice([None, "", "  ", *[" ".join(f"w{rng.randrange(99)}" for _ in range(rng.choice([1, 7, 40, 900])))] * 20]), rng.choice(["b", "a", None, "c"])) for d in range(400)]
    df = spark.createDataFrame([(k, *r) for k, r in enumerate(rows)], "row int, doc_id long, text string, source string")
    got = {r["row"]: sorted((d["shard"], d["words"]) for d in r["mix_draws"]) for r in M.mix_plan(df, block_words=64, shard_words=500).collect()}
    want = replay(rows)
    # Rows of one doc_id and text are alike, so their draws are compared together.
    groups = {}
    for k, r in enumerate(rows):
        groups.setdefault((r[0], r[1] or "", r[2]), []).append(k)
    for g in groups.values():
        assert sorted(x for k in g for x in got[k]) == sorted(x for k in g for x in want[k])


def test_clashing_names(spark):
    df = spark.createDataFrame([(1, "some words", "a", 9, 9)], "doc_id long, text string, source string, mix_size long, i int")
    assert M.mix_plan(df).columns == ["doc_id", "text", "source", "i", "mix_size", "mix_source_size", "mix_target", "mix_draws"] and M.mix_plan(df).first()["mix_size"] == 2


def test_mix(docs):
    out = M.mix(docs, block_words=64, shard_words=500)
    assert out.columns == docs.columns
    texts = {(r["doc_id"], r["text"]) for r in docs.collect()}
    size = lambda t: len((t or "").split())
    got = out.collect()
    cut = [r for r in got if (r["doc_id"], r["text"]) not in texts]
    assert len(cut) <= 4 and all(any(d == r["doc_id"] and (t or "").startswith(r["text"]) for d, t in texts) for r in cut)
    want = sum(sum(d["words"] for d in r["mix_draws"]) for r in plan(docs))
    assert sum(size(r["text"]) for r in got) == want


def test_empty(no_docs):
    assert plan(no_docs) == [] and M.mix(no_docs).count() == 0
