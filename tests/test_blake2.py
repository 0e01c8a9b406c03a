"""The digest in expressions, and in SQL, against the standard library's."""

import hashlib

import duckdb
from pyspark.sql import functions as F

from clausemill.functions import blake2
from clausemill.operators import vectors as V

TEXTS = ["", "a", "hóa", "thuế_1", "😀" * 20, "x" * 127, "y" * 128, "z" * 129, "đ" * 150, *("w" * k for k in (7, 8, 9, 255, 256, 257, 300))]


def value(text):
    return int.from_bytes(hashlib.blake2b(text.encode(), digest_size=8).digest(), "big")


def test_expression(spark):
    df = spark.createDataFrame([(t,) for t in [*TEXTS, None]], "t string")
    got = {r["t"]: r for r in df.select("t", blake2.first_word(F.col("t")).alias("w"), blake2.bucket(F.col("t"), 128).alias("b"), blake2.bucket(F.col("t"), 1_000_003).alias("big")).collect()}
    for t in TEXTS:
        assert got[t]["w"].to_bytes(8, "little", signed=True) == hashlib.blake2b(t.encode(), digest_size=8).digest()
        assert got[t]["b"] == value(t) % 128 == V.HashBag(128).bucket(t) and got[t]["big"] == value(t) % 1_000_003
    assert got[None]["w"] is None and got[None]["b"] is None


def test_sql():
    con = duckdb.connect()
    con.execute("CREATE TABLE tokens (token VARCHAR)")
    con.executemany("INSERT INTO tokens VALUES (?)", [[t] for t in TEXTS])
    got = dict(con.sql(f"WITH RECURSIVE {blake2.bucket_sql('tokens', 128)} SELECT token, bucket FROM hashed").fetchall())
    assert got == {t: value(t) % 128 for t in TEXTS}


def test_bags(spark):
    """The same bag by expressions and by the encoder, also of a key with several rows, without tokens, and null."""
    rows = [(1, "a b a Đ đ"), (1, "a c"), (2, ""), (3, None), (4, "x" * 200 + " y")]
    df = spark.createDataFrame(rows, "k int, t string")
    texts = {k: " ".join(t or "" for j, t in rows if j == k) for k, _ in rows}
    got = {}
    for r in V.blake2_bag(df, "k", "t", 64).collect():
        got.setdefault(r["k"], {})[r["bucket"]] = round(r["weight"], 5)
    assert got == {k: {i: round(float(x), 5) for i, x in enumerate(V.HashBag(64).encode(t)) if x} for k, t in texts.items() if t}


def test_embeddings_are_the_bag(spark, sf_dir):
    """What the query ``blake2_embed`` has as bytes is what ``blake2_bag`` has as rows."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").where("doc_id < 60")
    made = V.from_bytes(V.to_bytes(V.embed(docs, V.HashBag(128), "text"), 128).drop("embedding"))
    want = {(r["doc_id"], i): x for r in made.collect() for i, x in enumerate(r["embedding"]) if x}
    got = {(r["doc_id"], r["bucket"]): r["weight"] for r in V.encoder_bag(docs, "doc_id", "text", V.HashBag(128)).collect()}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-6 for k in got)
