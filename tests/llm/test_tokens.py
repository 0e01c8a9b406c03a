import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from clausemill.llm import packing, tokencount
from clausemill.llm.bytebpe import Encoder, vocabulary

ALPHABET = "ab  \n\t'sdé中1 2 　\x85\x1c!?Ⅷ½े😀ſ \r"


@pytest.fixture(scope="module")
def coders():
    own = Tokenizer.from_file(vocabulary())
    own.encode_special_tokens = True
    return Encoder(vocabulary()), own


def texts(n, seed):
    rng = random.Random(seed)
    return ["".join(rng.choice(ALPHABET) for _ in range(rng.choice([0, 3, 14, 60, 900]))) for _ in range(n)]


def test_ids(coders, docs):
    coder, own = coders
    for t in [*texts(400, 1), "<|endoftext|> a", *(r["text"] or "" for r in docs.collect())]:
        assert coder.ids(t) == own.encode(t, add_special_tokens=False).ids


@pytest.mark.parametrize("text", [" " * 1_000_000, "a b" + "\n" * 800_000 + " y  z", "\t \n" * 300_000 + "'s" + " " * 800_000, "x" + "　" * 70_000 + "!", "a" * 1_000_000, " " * 65_536 + "1"])
def test_long_runs(coders, text):
    coder, own = coders
    assert coder.ids(text) == own.encode(text, add_special_tokens=False).ids
    d = tokencount.Counted(text, coder)
    d.edit(5, 6, "x")
    assert d.tokens == coder.count(text[:5] + "x" + text[6:])


def test_edits(coders):
    coder, rng = coders[0], random.Random(2)
    for s in texts(150, 3):
        d = tokencount.Counted(s, coder)
        for new in texts(4, rng.random()):
            a, z = sorted((rng.randint(0, len(s) + 2), rng.randint(0, len(s) + 2)))
            s = s[:a] + new + s[max(min(a, len(s)), z) :]
            d.edit(a, z, new)
            assert d.text() == s and d.tokens == len(coder.ids(s))


def test_edits_touch_little(coders):
    d = tokencount.Counted("some plain words here " * 5000, coders[0])
    before = d.encoded
    d.edit(50_000, 50_004, "other")
    assert d.encoded - before < 1500


def test_easy_ends_are_ends_of_parts(coders):
    rng = random.Random(8)
    for t in [*texts(60, 9), *["".join(rng.choice(["word", "don't", "l'été", " ", " ", "\n", "12", "!", "中文", "  "]) for _ in range(rng.choice([5, 900, 4000]))) for _ in range(60)]]:
        parts = list(tokencount.cuts(t))
        assert "".join(parts) == t and sum(coders[0].count(p) for p in parts) == coders[0].count(t)
        d = tokencount.Counted(t, coders[0])
        again = tokencount.Counted(t, coders[0], (d.kept()["chars"], d.kept()["tokens"]))
        assert again.tokens == d.tokens and again.text() == t and again.encoded == 0


def test_kept_trees(spark, docs, no_docs, coders, tmp_path):
    edits = spark.createDataFrame([(7, 2, 0, 3, "Three"), (7, 1, None, None, "x "), (9, 1, 10, 20, None), (4, 1, 5, 9, "new"), (99, 1, 0, 1, "y")], "doc_id long, seq int, start long, end long, text string")
    ids = coders[0].ids
    tokencount.plant(docs).write.parquet(str(tmp_path / "one"))
    kept = spark.read.parquet(str(tmp_path / "one"))
    assert kept.columns == [*docs.columns, "n_tokens", "tree"] and kept.count() == docs.count()
    assert all(r["n_tokens"] == len(ids(r["text"] or "")) == sum(r["tree"]["tokens"]) and sum(r["tree"]["chars"]) == len(r["text"] or "") for r in kept.collect())
    later = tokencount.edit(tokencount.with_edits(kept, edits))
    assert later.columns == [*docs.columns, "n_tokens", "n_tokens_edited", "n_chars_edited", "n_chars_encoded", "tree"]
    later.write.parquet(str(tmp_path / "two"))
    got = spark.read.parquet(str(tmp_path / "two"))
    assert got.count() == docs.count()
    for r in got.collect():
        text = r["text"] or ""
        after = {7: "Three" + ("x " + text)[3:], 9: text[:10] + text[20:], 4: "new"}.get(r["doc_id"], text)
        assert r["n_tokens"] == len(ids(text)) and r["n_tokens_edited"] == len(ids(after)) == sum(r["tree"]["tokens"])
        assert r["tree"]["text"] == after and r["n_chars_edited"] == len(after)
        assert (r["n_chars_encoded"] == 0) == (after == text) and r["n_chars_encoded"] <= 2500
    assert tokencount.plant(no_docs).count() == 0 and tokencount.edit(kept.limit(0).withColumn("edits", F.lit(None))).count() == 0


def test_new_versions(spark, docs, coders):
    kept = tokencount.plant(docs)
    said = {r["doc_id"]: r["text"] for r in docs.collect()}
    changed = {9: said[9][:3000] + " and more" + said[9][3010:], 1: said[1], 5: "no longer empty", 4: None, 50: "a new document", None: "without an id"}
    rows = tokencount.renew(spark.createDataFrame(list(changed.items()), "doc_id long, text string"), kept).collect()
    assert len(rows) == len(changed)
    for r in rows:
        d, text = r["doc_id"], r["text"] or ""
        assert r["n_tokens_edited"] == coders[0].count(text) and r["tree"]["text"] == text
        assert r["n_chars_encoded"] <= {9: 2500, 1: 0, 4: 0}.get(d, len(text))


def test_clashing_names(spark):
    df = spark.createDataFrame([(1, "two words", 9, "x")], "doc_id long, text string, n_tokens long, tree string")
    out = tokencount.plant(df)
    assert out.columns == ["doc_id", "text", "n_tokens", "tree"] and out.first()["n_tokens"] == 2


def test_hilbert():
    for dims, bits in ((2, 3), (3, 2), (4, 2)):
        axes = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims, indexing="ij"), -1).reshape(-1, dims)
        place = packing.hilbert(axes, bits)
        assert sorted(place) == list(range(len(axes)))
        walk = axes[np.argsort(place)]
        assert (np.abs(np.diff(walk, axis=0)).sum(1) == 1).all()


def test_packing(docs, no_docs, coders):
    pieces = packing.pack(docs, length=64, carry=("doc_id", "text", "size")).collect()
    coder = coders[0]
    by = {}
    for p in pieces:
        by.setdefault((p["doc_id"], p["text"]), []).append(p)
    copies = {}
    for r in docs.collect():
        copies[r["doc_id"], r["text"]] = copies.get((r["doc_id"], r["text"]), 0) + 1
    assert set(by) == set(copies)
    for (d, t), ps in by.items():
        want = [*coder.ids(t), 1]
        assert sum(len(p["ids"]) for p in ps) == copies[d, t] * len(want)
        for p in ps:
            assert p["ids"] == want[p["start"] : p["start"] + len(p["ids"])] and p["doc_tokens"] == len(want)
    full = {}
    for p in pieces:
        full.setdefault(p["sequence_id"], []).append((p["offset"], len(p["ids"])))
    for k, parts in full.items():
        end = 0
        for a, n in sorted(parts):
            assert a == end
            end += n
        assert end <= 64 and (end & (end - 1)) == 0, k
    assert sorted(full) == list(range(len(full)))
    rows = packing.digest(packing.pack(docs, length=64))
    assert rows.count() == len(pieces) and packing.pack(no_docs).count() == 0
    made = packing.sequences(packing.pack(docs, length=64))
    assert {len(r["ids"]) for r in made.collect()} <= {1, 2, 4, 8, 16, 32, 64}
