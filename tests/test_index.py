"""Many queries against a kept index of cards, held against a comparison with all of them."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from clausemill.operators import index as I

CARDS = "card_id long, document_id long, citation string, bound_actor string, topic_tags array<string>, penalty string, embedding array<float>"
CLAUSES = "document_id long, kind string, number string, dieu string"
ASKED = "query_id long, embedding array<float>, document_id long, article string, khoan string, actor string, topic string, penalty boolean"


def vectors_of(n, dim, seed, groups):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(groups, dim))
    return (centres[rng.integers(0, groups, n)] + 0.4 * rng.normal(size=(n, dim))).astype(np.float32)


@pytest.fixture(scope="module")
def corpus(spark):
    x = vectors_of(3000, 24, 1, 30)
    rows = []
    for i, v in enumerate(x):
        topics = [["hóa đơn"], ["phạt", "thuế"], [], None][i % 4]
        rows.append((i, i % 40, f"Điều {i // 40 + 1}", ["tổ chức", "cá nhân", None][i % 3], topics, "5" if i % 5 == 0 else None, [float(c) for c in v]))
    rows[10] = (*rows[10][:6], [0.0] * 24)
    rows[11] = (*rows[11][:6], rows[12][6])  # equal vectors
    odd = [(5001, 1, "Điều 9", None, None, None, None), (5002, 1, "Điều 9", None, None, None, [1.0, 2.0]), (None, 1, "Điều 9", None, None, None, [1.0] * 24)]
    cards = spark.createDataFrame(rows + odd, CARDS)
    below = spark.createDataFrame([(d, "khoan", str(k), str(a)) for d in range(0, 40, 2) for a in (1, 2, 7) for k in (1, 2)] + [(0, "dieu", "1", "1")], CLAUSES)
    return rows, I.described(cards, below)


def queries_of(spark, n=120):
    q = vectors_of(n, 24, 2, 30)
    rows = []
    for i, v in enumerate(q):
        rows.append((i, [float(c) for c in v], 6 if i % 9 == 1 else None, "2" if i % 9 == 2 else None, "1" if i % 9 == 3 else None, "cá nhân" if i % 9 in (4, 5) else None, "thuế" if i % 9 in (5, 6) else None, [None, True, False][i % 3] if i % 9 == 7 else None))
    rows.append((900, [0.0] * 24, None, None, None, None, None, None))
    rows.append((901, None, None, None, None, None, None, None))
    rows.append((902, [1.0], None, None, None, None, None, None))
    rows.append((903, rows[0][1], None, None, None, None, "no such topic", None))
    return rows, spark.createDataFrame(rows, ASKED)


def brute(cards, asked, k):
    out = {}
    x = np.array([c[6] for c in cards], float)
    size = np.linalg.norm(x, axis=1)
    for query, v, document, article, khoan, actor, topic, penalty in asked:
        if v is None or len(v) != x.shape[1]:
            continue
        length = size * np.linalg.norm(v)
        score = np.divide(x @ np.array(v, np.float32).astype(float), length, out=np.zeros(len(x)), where=length > 0)
        fits = []
        for c, s in zip(cards, score, strict=True):
            number = c[2].split()[1]
            inside = c[1] % 2 == 0 and number in ("1", "2", "7")
            if (document in (None, c[1])) and (article in (None, number)) and (khoan is None or inside) and (actor in (None, c[3])) and (topic is None or topic in (c[4] or [])) and (penalty in (None, c[5] is not None)):
                fits.append((-round(s, 9), c[0]))
        out[query] = [i for _, i in sorted(fits)[:k]]
    return {q: ids for q, ids in out.items() if ids}


def found(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r["query_id"], []).append(r["card_id"])
    return out


@pytest.mark.parametrize("settings,turn", [(I.Settings(list_cards=100), 8192), (I.Settings(lists=3, block_cards=200, pieces=5, fit_rows=300), 50)])
def test_all_of_the_best_with_filters(spark, corpus, tmp_path, monkeypatch, settings, turn):
    """Lists held in several blocks, few lists, queries in turns: the same cards as by comparing all."""
    monkeypatch.setattr(I, "QUERY_BLOCK", turn)
    rows, cards = corpus
    I.Index.build(cards, str(tmp_path / "index"), settings)
    asked, queries = queries_of(spark)
    index = I.Index(spark, str(tmp_path / "index"))  # as a later session finds it
    assert found(index.search(queries, 7)) == brute(rows, asked, 7)


def test_recall_with_less_slack(spark, corpus, tmp_path):
    rows, cards = corpus
    index = I.Index.build(cards, str(tmp_path / "index"), I.Settings(list_cards=50))
    asked, queries = queries_of(spark)
    want, got = brute(rows, asked, 10), found(index.search(queries, 10, probes=4, slack=0.2))
    hits = sum(len(set(want[q]) & set(got.get(q, []))) for q in want)
    assert hits >= 0.95 * sum(map(len, want.values()))


def test_codes_keep_their_promise():
    x = I._unit(list(vectors_of(2000, 24, 5, 10)), 24)
    model = I.Model.fit(x[:500], 12, 6, 3)
    home, code, off, far = model.encode(x)
    about = model.centroids[home] + model.decode(code)
    q = I._unit(list(vectors_of(50, 24, 6, 10)), 24)
    assert (np.abs(q @ x.T - q @ about.T) <= off + 1e-9).all()
    assert (np.abs(q @ x.T - q @ model.centroids[home].T) <= far + 1e-9).all()
    assert off.mean() < 0.7 * far.mean()


def test_few_and_no_cards(spark, corpus, tmp_path):
    rows, cards = corpus
    asked, queries = queries_of(spark, 5)
    one = I.Index.build(cards.where("card_id = 3"), str(tmp_path / "one"))
    assert found(one.search(queries.where("topic IS NULL AND actor IS NULL AND document_id IS NULL AND article IS NULL AND khoan IS NULL"), 4)) == {0: [3], 900: [3]}
    none = I.Index.build(cards.where("card_id < 0"), str(tmp_path / "none"))
    assert none.search(queries, 4).count() == 0
    plain = queries.select("query_id", "embedding").limit(0)
    assert one.search(plain, 4).count() == 0


def test_what_moves_does_not_grow_with_the_cards_that_may_be_best(spark, tmp_path):
    """All vectors are alike, so every card may be among every query's best: a query comes to a shard once and leaves with k cards."""
    rng = np.random.default_rng(4)
    one = rng.normal(size=16).astype(np.float32)
    x = [one if i % 2 else (one + 1e-4 * rng.normal(size=16)).astype(np.float32) for i in range(1200)]
    cards = [(i, 0, "Điều 1", None, None, None, [float(c) for c in v]) for i, v in enumerate(x)]
    settings = I.Settings(list_cards=20, block_cards=30, shard_cards=400)
    index = I.Index.build(I.described(spark.createDataFrame(cards, CARDS), spark.createDataFrame([], CLAUSES)), str(tmp_path / "index"), settings)
    assert {r["shard"]: r["n"] for r in index.codes.groupBy("shard").agg(F.count("*").alias("n")).collect()}.keys() == {0, 1, 2}
    asked = [(i, [float(c) for c in x[2 * i + 1]], *[None] * 6) for i in range(40)]
    queries = spark.createDataFrame(asked, ASKED)
    live = queries.select("query_id", F.col("embedding").cast("array<float>").alias("q"), F.lit(-2.0).alias("floor"), *I.FILTERS)
    visits = index._visits(live, "shards", 8)
    assert visits.count() == 3 * len(asked)
    assert index._scan(visits, ["shard"], 5, 1.0, 1).count() == 3 * 5 * len(asked)
    assert found(index.search(queries, 5)) == {i: [1, 3, 5, 7, 9] for i in range(40)}
