import random
import re
from collections import Counter

import pytest

from clausemill.llm import phrases


def brute(rows, least, share=100, most=2000):
    """rows (text, lang) -> the contract, counted in plain loops."""
    n, f = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", low):
            w = re.findall("[^ \t]+", piece)
            n[lang] += len(w)
            for i in range(len(w)):
                for k in range(1, 6):
                    if i + k <= len(w):
                        f[lang, tuple(w[i : i + k])] += 1
    good = {key: a for key, a in f.items() if a >= least}
    by_lang = {}
    for (lang, p), a in good.items():
        if len(p) < 2:
            continue
        inside = any(g != p and o == lang and len(g) > len(p) and share * a <= 100 * b and any(g[i : i + len(p)] == p for i in range(len(g))) for (o, g), b in good.items())
        if inside:
            continue
        cuts = [(1000 * a * n[lang] // (f[lang, p[:k]] * f[lang, p[k:]]), k) for k in range(1, len(p))]
        score, k = min(cuts)
        by_lang.setdefault(lang, []).append((-score, -a, " ".join(p).encode(), f[lang, p[:k]], f[lang, p[k:]]))
    return sorted((lang, i, p.decode(), -a, left, right, n[lang], -score) for lang, found in by_lang.items() for i, (score, a, p, left, right) in enumerate(sorted(found)[:most], 1))


def found(df, least, **o):
    return sorted(tuple(r) for r in phrases.collocations(df, least, **o).collect())


def corpus(seed, n=300):
    rng = random.Random(seed)
    vocabulary = ["a", "b\x01", "b", "B", "c", "cc", "đ", "x-y", "w"]
    rows = []
    for _ in range(n):
        words = rng.choices(vocabulary, [9, 1, 5, 3, 2, 1, 1, 1, 1], k=rng.randint(0, 40))
        rows.append(("".join(w + rng.choice([" ", " ", " ", "\t", "  ", ". ", "\n", ";"]) for w in words), rng.choice(["en", "en", "fr", None, "und"])))
    return rows


@pytest.mark.parametrize("seed,least,size,bits", [(1, 3, 4 << 20, 27), (2, 2, 200, 27), (3, 5, 1, 6)])
def test_against_plain_counts(spark, seed, least, size, bits):
    """Shards of all sizes down to a piece, a table of so few bits that nearly every pair gets through, and ranges that cut paths."""
    rows = corpus(seed)
    df = spark.createDataFrame(rows, "text string, lang string").repartition(3)
    assert found(df, least, shard_bytes=size, bits=bits) == brute(rows, least)


def test_many_ranges_and_one_common_pair(spark):
    """A pair with most of all places lies on many ranges: its count, and those of all nodes below it, come from several tasks."""
    rng = random.Random(7)
    rows = [(" ".join(f"of the {rng.choice('abcdefgh')} {rng.choice('klm')}" for _ in range(12)), "en") for _ in range(120)]
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    try:
        assert found(spark.createDataFrame(rows, "text string, lang string"), 10) == brute(rows, 10)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_share_and_number_of_rows(spark):
    rows = corpus(5)
    df = spark.createDataFrame(rows, "text string, lang string")
    assert found(df, 4, share=60, most=3) == brute(rows, 4, 60, 3)


def test_edges(spark, docs, no_docs):
    rows = [(r["text"], r["lang"]) for r in docs.collect()]
    assert found(docs, 2) == brute(rows, 2)
    assert found(no_docs, 1) == []
    assert found(docs.where("doc_id IN (4, 5, 6)"), 1) == []


def test_counts_beyond_64_bits(spark):
    """The product of a count, the language's size and 1000 is taken in 38 digits."""
    big = spark.sql("SELECT cast(9000000000000000 AS bigint) AS a").selectExpr("cast(1000 AS decimal(4,0)) * cast(a AS decimal(19,0)) * cast(a AS decimal(19,0)) AS over", "cast(a AS decimal(19,0)) * cast(a AS decimal(19,0)) AS under")
    assert big.selectExpr("over div under AS q").first()["q"] == 1000
