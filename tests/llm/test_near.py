import random

import numpy as np
import pytest

from clausemill.llm import near


def sets_of(text):
    w = (text or "").encode().lower().split()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute(rows):
    sets = [sets_of(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    least = {}
    for i, (d, _) in enumerate(rows):
        r = find(i)
        if d is not None:
            least[r] = min(d, least.get(r, d))
    return [(d, len(sets[i]), least.get(find(i), d)) for i, (d, _) in enumerate(rows)]


def corpus(seed, n=160):
    """Chains and groups of near copies around the threshold, shared passages, repeated words."""
    rng = random.Random(seed)
    word = lambda: rng.choice("abcdefghij") + rng.choice("klmnop") + rng.choice("qrstuv")
    passage = [word() for _ in range(40)]
    rows, bases = [], [[word() for _ in range(rng.randint(3, 90))] for _ in range(12)]
    for d in range(n):
        w = list(rng.choice(bases))
        if rng.random() < 0.3:
            w = [*w, *passage]
        for _ in range(rng.choice([0, 1, 1, 2, 3, 5])):
            k = rng.randrange(len(w) + 1)
            w[k : k + rng.choice([0, 1])] = [word()]
        if rng.random() < 0.05:
            w = [word()] * rng.randint(1, 30)
        rows.append((d, rng.choice([" ", "\n", "  "]).join(w).title()))
    rng.shuffle(rows)
    return rows


def found(df, **o):
    return sorted((r["doc_id"] if r["doc_id"] is not None else -1, r["n_shingles"], r["component_id"] if r["component_id"] is not None else -1) for r in near.near_duplicates(df, **o).collect())


@pytest.mark.parametrize("seed,hot,run,size", [(1, 512, 1 << 20, 1 << 21), (2, 3, 400, 300), (3, 512, 900, 1 << 21), (4, 2, 1 << 20, 50)])
def test_against_all_pairs(spark, monkeypatch, seed, hot, run, size):
    rows = corpus(seed)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    # Workers import the module themselves, so what they use of it is put into the functions that go there.
    for name in ("_runs", "_bin", "_part"):
        made = getattr(near, name)
        monkeypatch.setattr(near, name, lambda *a, made=made: within(made(*a), hot, run))
    monkeypatch.setattr(near, "BIN", size)
    assert found(df, carry=["doc_id"]) == sorted(brute(rows))


def within(f, hot, run):
    def g(*a):
        from clausemill.llm import near as n

        old = n.HOT, n.RUN
        n.HOT, n.RUN = hot, run
        try:
            yield from f(*a)
        finally:
            n.HOT, n.RUN = old

    return g


def test_bins_cover_all_hashes():
    rng = np.random.default_rng(4)
    h = np.sort(rng.integers(0, 1 << near.BITS, 5000, dtype=np.uint64))
    for bins in (1, 7, 211, 70_000):
        cuts = near._cuts(h, bins)
        assert cuts[0] == 0 and cuts[-1] == len(h) and (np.diff(cuts) >= 0).all()
        for k in np.flatnonzero(np.diff(cuts)):
            part = h[cuts[k] : cuts[k + 1]]
            assert part[0] >= near._base(int(k), bins) and part[-1] < near._base(int(k) + 1, bins)


def test_clashing_names(spark):
    df = spark.createDataFrame([(1, "a b", 5, 6, "x")], "doc_id long, text string, n_shingles int, component_id int, data string")
    out = near.near_duplicates(df)
    assert out.columns == ["doc_id", "text", "data", "n_shingles", "component_id"] and out.first()["n_shingles"] == 1


def test_prefix_keeps_every_pair():
    rng = random.Random(7)
    df = {g: rng.randint(1, 9) for g in range(400)}
    for _ in range(300):
        a = set(rng.sample(range(60), rng.randint(20, 60)))
        b = (a | set(rng.sample(range(60, 400), 5))) - set(rng.sample(sorted(a), 3))
        if 100 * len(a & b) < 80 * len(a | b):
            continue
        picks = []
        for s in (a, b):
            shared = np.array(sorted(g for g in s if df[g] > 1 or g in a & b))
            freq = np.array([max(2, df[g]) for g in shared])
            picks.append(near.prefix(len(s), -(-len(s) * 80 // 100), shared, freq))
        (x, l), (y, m) = picks
        assert len(set(x.tolist()) & set(y.tolist())) >= min(l, m)


def test_edges(docs, no_docs):
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    want = sorted((d if d is not None else -1, n, c if c is not None else -1) for d, n, c in brute(rows))
    assert found(docs, carry=["doc_id"]) == want
    out = near.near_duplicates(docs)
    assert out.columns == [*docs.columns, "n_shingles", "component_id"] and out.count() == docs.count()
    assert near.near_duplicates(no_docs).count() == 0


def test_other_columns_with_repeated_ids(spark):
    """Every row has the results of its own text, whatever its id and whatever it carries."""
    said = "a b c d e f g h"
    rows = [(1, said, "x"), (1, "q", "y"), (1, "q", "y"), (2, said, "z"), (1, None, None), (None, said, "n")]
    df = spark.createDataFrame(rows, "doc_id long, text string, other string")
    want = sorted(((d, t, o, n, c) for (d, t, o), (_, n, c) in zip(rows, brute([(d, t) for d, t, _ in rows]), strict=True)), key=repr)
    assert sorted(map(tuple, near.near_duplicates(df).collect()), key=repr) == want
    assert (1, said, "x", 4, 1) in want and (1, "q", "y", 1, 1) in want
    short = near.near_duplicates(df, carry=["other"], root=True)
    assert short.columns == ["other", "n_shingles", "component_id", "component_root"]
    by_root = {}
    for r in short.collect():
        by_root.setdefault(r["component_root"], []).append(r["other"] or "")
    assert sorted(map(sorted, by_root.values())) == [[""], ["n", "x", "z"], ["y", "y"]]
