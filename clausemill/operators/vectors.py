"""Hashed bags of words, norms, similarity and dimension checks."""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator
from typing import Protocol, runtime_checkable

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import blake2
from ..functions import text as X
from ..schemas import DEFAULT_DIM, MODEL_DIM

#: Texts whose vectors a task holds at a time.
ENCODED = 256


@runtime_checkable
class Encoder(Protocol):
    """Texts to vectors of dim numbers; used inside a task, so it must pickle."""

    dim: int

    def encode(self, text: str) -> np.ndarray: ...

    def encode_batch(self, texts: list[str]) -> np.ndarray: ...


def normalize(v: np.ndarray) -> np.ndarray:
    """Rows of length one; zero rows stay."""
    if v.ndim not in (1, 2):
        raise ValueError("a vector or a matrix is asked for")
    norm = np.linalg.norm(v, axis=-1, keepdims=True)
    return np.divide(v, norm, out=v.astype(np.float32), where=norm > 0).astype(np.float32)


class HashBag:
    """Words in buckets by an eight-byte BLAKE2b digest, counted and normalised."""

    def __init__(self, dim: int = DEFAULT_DIM):
        if dim <= 0:
            raise ValueError("dim must be positive")
        self.dim = dim
        self._memo: dict[str, int] = {}

    def bucket(self, token: str) -> int:
        if token not in self._memo:
            if len(self._memo) > 100_000:
                self._memo.clear()
            self._memo[token] = int.from_bytes(hashlib.blake2b(token.encode(), digest_size=8).digest(), "big") % self.dim
        return self._memo[token]

    def count_tokens(self, tokens: list[str]) -> np.ndarray:
        return np.bincount([self.bucket(t) for t in tokens], minlength=self.dim)

    def count(self, text: str) -> np.ndarray:
        import regex

        return self.count_tokens(regex.findall(r"[\p{L}\p{N}_]+", text.lower()))

    def encode_tokens(self, tokens: list[str]) -> np.ndarray:
        return normalize(self.count_tokens(tokens).astype(np.float32))

    def encode(self, text: str) -> np.ndarray:
        return normalize(self.count(text).astype(np.float32))

    def encode_batch(self, texts: list[str]) -> np.ndarray:
        return np.stack([self.encode(t) for t in texts]) if texts else np.zeros((0, self.dim), np.float32)


class ModelEncoder:
    """A sentence model of an optional package, loaded by the first task that needs it."""

    dim = MODEL_DIM

    def __init__(self, name: str):
        self.name, self._model = name, None

    def encode_batch(self, texts: list[str]) -> np.ndarray:
        if self._model is None:
            try:
                from sentence_transformers import SentenceTransformer
            except ImportError as gone:
                raise RuntimeError("the model encoder needs the package sentence-transformers") from gone
            self._model = SentenceTransformer(self.name)
        return normalize(np.asarray(self._model.encode(list(texts)), np.float32))

    def encode(self, text: str) -> np.ndarray:
        return self.encode_batch([text])[0]


def default_encoder(dim: int = DEFAULT_DIM, model: str | None = None, variable: str = "CLAUSEMILL_EMBEDDING_MODEL") -> Encoder:
    """The model that is named, here or by the environment variable; else the hashing encoder."""
    model = model or os.environ.get(variable)
    return ModelEncoder(model) if model else HashBag(dim)


def embed(texts: DataFrame, encoder: Encoder, column: str = "embed_text") -> DataFrame:
    """texts with ``embedding``, array of float; an iterator UDF, so an encoder loads once a task, and holds the vectors of ``ENCODED`` texts at a time."""

    @F.pandas_udf("array<float>")
    def encode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for b in batches:
            for i in range(0, len(b), ENCODED):
                yield pd.Series(list(encoder.encode_batch([t or "" for t in b.iloc[i : i + ENCODED]])))

    return texts.withColumn("embedding", encode(F.col(column)))


def to_bytes(embeddings: DataFrame, dim: int | None = None, column: str = "embedding") -> DataFrame:
    """``embedding_bytes``: float32 in native order; fails where a vector has another dimension than asked."""

    @F.arrow_udf("binary")
    def pack(vectors: pa.Array) -> pa.Array:
        sizes = np.asarray(vectors.value_lengths().fill_null(-1))
        wrong = np.flatnonzero((sizes >= 0) & (sizes != dim)) if dim is not None else ()
        if len(wrong):
            raise ValueError(f"a vector has {sizes[wrong[0]]} components, not {dim}")
        flat = np.ascontiguousarray(vectors.flatten().cast(pa.float32()).to_numpy(zero_copy_only=False))
        ends = np.concatenate([[0], np.cumsum(4 * np.maximum(sizes, 0))]).astype(np.int64)
        # One buffer cut at the vectors' ends: no Python object for each.
        whole = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(sizes), [None, pa.py_buffer(ends), pa.py_buffer(flat)])
        return pc.if_else(pa.array(sizes >= 0), whole, None).cast(pa.binary())

    return embeddings.withColumn("embedding_bytes", pack(F.col(column)))


def from_bytes(rows: DataFrame, column: str = "embedding_bytes") -> DataFrame:
    @F.pandas_udf("array<float>")
    def read(data: pd.Series) -> pd.Series:
        return data.map(lambda b: None if b is None else np.frombuffer(b, np.float32))

    return rows.withColumn("embedding", read(F.col(column)))


# ---- the same in SQL functions


def token_counts(texts: DataFrame, key: str, column: str) -> DataFrame:
    """key, token, n."""
    return texts.select(key, F.explode(X.tokens(F.col(column))).alias("token")).groupBy(key, "token").agg(F.count("*").alias("n"))


def md5_bucket(token: Column, dim: int) -> Column:
    return (F.conv(F.substring(F.md5(token), 1, 8), 16, 10).cast("long") % dim).cast("int")


def _weighed(per: DataFrame, key: str) -> DataFrame:
    """key, bucket, n with weight; the norm's window has the partitioning of the counts."""
    norm = F.sqrt(F.sum((F.col("n") * F.col("n")).cast("double")).over(Window.partitionBy(key)))
    return per.withColumn("weight", F.col("n") / norm)


def hashed_bag(texts: DataFrame, key: str, column: str, dim: int = DEFAULT_DIM) -> DataFrame:
    """key, bucket, n, weight: the bag's buckets that aren't empty, and their parts of a unit vector; buckets by MD5.

    One exchange on the key. Counting within the row, by sorted arrays, needs none but was slower: 57 s against 21 s at sf0.1.
    """
    rows = texts.select(key, F.explode(X.tokens(F.col(column))).alias("token")).select(key, md5_bucket(F.col("token"), dim).alias("bucket"))
    return _weighed(rows.groupBy(key, "bucket").agg(F.count("*").alias("n")), key)


def encoder_bag(texts: DataFrame, key: str, column: str, encoder: HashBag) -> DataFrame:
    """As ``hashed_bag`` by the encoder's own buckets, for keys with one row each: bags are counted in Arrow batches and leave no row."""

    @F.pandas_udf("array<long>")
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for b in batches:
            yield pd.Series([encoder.count(t or "") for t in b])

    rows = texts.select(key, count(F.col(column)).alias("bag"))
    norm = F.sqrt(F.aggregate("bag", F.lit(0.0), lambda s, n: s + (n * n).cast("double")))
    each = rows.select(key, norm.alias("norm"), F.posexplode("bag").alias("bucket", "n")).where("n > 0")
    return each.select(key, "bucket", "n", (F.col("n") / F.col("norm")).alias("weight"))


def blake2_bag(texts: DataFrame, key: str, column: str, dim: int = DEFAULT_DIM) -> DataFrame:
    """As ``encoder_bag`` for any keys, without Python: each distinct token is hashed once, by expressions. That takes some milliseconds of
    a core for a token, where the encoder takes microseconds, so it is for where no Python may run."""
    counts = token_counts(texts, key, column)
    # By number, as few bytes here are much work.
    n = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    words = counts.select("token").repartition(n, "token").distinct().select(F.col("token").alias("word"), blake2.bucket(F.col("token"), dim).alias("bucket"))
    per = counts.join(words, F.col("token") == F.col("word")).groupBy(key, "bucket").agg(F.sum("n").alias("n"))
    return _weighed(per, key)


def norm(vector: Column) -> Column:
    return F.sqrt(F.aggregate(vector, F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")))


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def normalized(vector: Column) -> Column:
    n = norm(vector)
    return F.when(n == 0, vector.cast("array<double>")).otherwise(F.transform(vector, lambda x: x.cast("double") / n))


def dimension_audit(rows: DataFrame, key: str, expected: int, column: str = "embedding") -> DataFrame:
    """One row: vectors checked, how many have another dimension, and whether none has; ``dimension_mismatches`` says which."""
    have = rows.where(F.col(column).isNotNull())
    return have.agg(F.count("*").alias("checked"), F.count_if(F.size(column) != expected).alias("mismatched")).withColumn("ok", F.col("mismatched") == 0)


def dimension_mismatches(rows: DataFrame, key: str, expected: int, column: str = "embedding") -> DataFrame:
    """id, actual, expected of the vectors of another dimension."""
    wrong = rows.where(F.col(column).isNotNull() & (F.size(column) != expected))
    return wrong.select(F.col(key).alias("id"), F.size(column).alias("actual"), F.lit(expected).alias("expected"))


def most_similar(rows: DataFrame, key: str, query: list[float], k: int, column: str = "embedding") -> DataFrame:
    """The k rows of the highest cosine with one query vector: a map and a bounded top-k, no exchange of all rows."""
    wanted = F.array(*[F.lit(float(x)) for x in query])
    length = norm(F.col(column)) * norm(wanted)
    score = F.when(length > 0, dot(F.col(column), wanted) / length).otherwise(F.lit(0.0))
    return rows.where(F.col(column).isNotNull()).select(key, score.alias("cosine")).orderBy(F.desc("cosine"), key).limit(k)
