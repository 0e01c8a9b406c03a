import re
from collections import Counter

import corpus_pipeline
from clausemill.llm import langid, stages
from clausemill.llm.bytebpe import Encoder, vocabulary
from test_mixing import replay
from test_near import brute


def test_stages(spark, docs, sf_dir):
    columns = docs.columns
    known = stages.identify_language(spark, docs, sf_dir)
    assert known.columns == columns
    model = langid.fit(docs, docs["lang"].isNotNull())
    want = Counter(str(r["text"]) for r in docs.collect() if not model(r["text"])[2])
    assert Counter(str(r["text"]) for r in known.collect()) == want

    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    single = stages.drop_near_duplicates(spark, docs, sf_dir)
    assert single.columns == columns
    keep = {d for d, _, c in brute([r for r in rows if r[0] is not None]) if d == c} | {None}
    assert sorted((r["doc_id"] or -1) for r in single.collect()) == sorted(k or -1 for k in keep)

    clean = stages.redact_secrets(spark, docs, sf_dir)
    assert clean.columns == columns and clean.count() == docs.count()
    got = {r["doc_id"]: r for r in clean.collect()}
    assert got[10]["text"] == "[SECRET]' và [SECRET] [SECRET] 😀 token:short" and got[10]["n_chars"] == len(got[10]["text"])
    assert all(got[d]["text"] == t for d, t in rows if d not in (10, None))

    mixed = stages.mix_sources(spark, docs, sf_dir)
    assert mixed.columns == columns
    # By a plain replay: each draw is a row with the first words that it takes.
    every = [(r["doc_id"], r["text"], r["source"]) for r in docs.collect()]
    cut = lambda t, n: "".join(re.findall(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+", t or "")[:n])
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    want = Counter((d, t if n == size(t) else cut(t, n), s) for (d, t, s), draws in zip(every, replay(every, block_words=4096, shard_words=1 << 18), strict=True) for _, n in draws)
    assert Counter((r["doc_id"], r["text"], r["source"]) for r in mixed.collect()) == want and sum(want.values()) > 5

    pieces = stages.pack_sequences(spark, docs, sf_dir).collect()
    coder = Encoder(vocabulary())
    assert sum(len(p["ids"]) for p in pieces) == sum(len(coder.ids(t or "")) + 1 for _, t in rows)


def test_different_texts_under_one_id(spark, sf_dir):
    x, y, z = (" ".join(f"{c}{k}" for k in range(60)) for c in "xyz")
    rows = [(3, x), (5, x), (5, y), (7, z), (7, y + " more"), (8, None), (8, ""), (8, ""), (None, x)]
    single = stages.drop_near_duplicates(spark, spark.createDataFrame(rows, "doc_id long, text string"), sf_dir)
    want = [(3, x), (5, y), (7, z), (8, None), (8, ""), (None, x)]
    assert Counter(map(tuple, single.collect())) == Counter(want)


def test_empty(spark, no_docs, sf_dir):
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, no_docs, sf_dir)
        assert out.count() == 0 and (k == 4 or out.columns == no_docs.columns)


def test_run(spark, sf_dir):
    first, again = (corpus_pipeline.run(spark, sf_dir).select("doc_id", "start", "sequence_id", "offset").collect() for _ in range(2))
    assert len(first) > 100 and sorted(map(tuple, first)) == sorted(map(tuple, again))


def test_rows_of_one_text_and_id(spark, sf_dir):
    """Rows equal in doc_id and text but not in other columns: one of them stays, the same one in every order and partitioning."""
    x = " ".join(f"x{k}" for k in range(60))
    rows = [(3, x, "b", "en"), (3, x, "a", "en"), (3, x, "a", None), (3, x, None, None), (4, x, "a", "en"), (9, None, "a", "en"), (9, None, "b", "en"), (9, None, "b", "en")]
    made = [stages.drop_near_duplicates(spark, spark.createDataFrame(rows[::way], "doc_id long, text string, source string, lang string").repartition(n), sf_dir) for way, n in ((1, 1), (-1, 4))]
    first, again = (sorted(map(tuple, m.collect()), key=repr) for m in made)
    assert first == again and [r[0] for r in first] == [3, 9] and set(first) <= set(rows)
