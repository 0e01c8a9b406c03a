"""The stages of the corpus pipeline: documents in, documents out, but for the last.

Every stage takes (spark, docs, sf_dir) and works on all of docs. Extra columns pass through; nulls, empty
and repeated rows and empty tables are as each operator defines them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import langid, mixing, near, packing, secrets
from ._shared import Scratch


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language compression tells; those it rejects (no letter, or a narrow margin) go."""
    judged = langid.identify(docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), "text", "lang", "doc_id"), carry=["doc"])
    return judged.where(~F.col("lang_rejected")).select("doc.*")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, that of the least doc_id, of several of that doc_id the least text, and of
    several of that text the row with the least MD5 of all columns; runs agree.

    Groups are of texts, not of ids: different texts under one doc_id are each in their own group. Texts without a word are
    like no other, but equal ones under one doc_id are one. Documents without a doc_id stay.
    """
    named = docs.where(F.col("doc_id").isNotNull())
    others = F.to_json(F.struct(F.lit(0).alias("_"), *[F.col(f"`{c}`") for c in docs.columns if c not in ("doc_id", "text")]))
    said = F.coalesce(F.md5("text"), F.lit("-"))
    key = F.unhex(F.md5(F.concat_ws("|", F.col("doc_id").cast("string"), said, others)))  # stands for a whole row: equal rows are one
    scratch = Scratch(spark, "groups")
    found = near.near_duplicates(named.select(key.alias("__key"), F.concat_ws("|", F.col("doc_id").cast("string"), said).alias("__alone"), "doc_id", "text"), carry=["__key", "__alone", "doc_id"], root=True)
    # A group's rows of its first doc_id; texts without a word are grouped by doc_id and text.
    first = found.where(F.col("doc_id") == F.col("component_id")).select("__key", F.coalesce(F.col("component_root").cast("string"), "__alone").alias("__group"))
    kept = scratch.keep(first.distinct(), "kept")
    # Only where a group still has several rows, their texts decide, and then the rows; the others' are not looked at.
    several = kept.groupBy("__group").count().where("count > 1").select("__group")
    tied = named.select(key.alias("__key"), F.col("text").alias("__text")).join(kept.join(several, "__group", "left_semi"), "__key")
    winners = tied.groupBy("__group").agg(F.min(F.struct(F.col("__text").isNull().alias("none"), F.col("__text").alias("text"), F.col("__key").alias("key"))).alias("w")).select(F.col("w.key").alias("__key"))
    chosen = kept.join(several, "__group", "left_anti").select("__key").union(winners)
    # Equal rows become one before they move, and rows move once, by the key of the join.
    whole = named.select(key.alias("__key"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc")).groupBy("__key").agg(F.first("doc").alias("doc"))
    rows = whole.join(chosen, "__key", "left_semi").select("doc.*")
    return rows.unionByName(docs.where(F.col("doc_id").isNull()))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, each secret replaced by a mark."""
    found, _ = secrets.scan(docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"), "text"), carry=["doc"], keep=Scratch(spark, "secrets"))
    hit = F.size("spans") > 0
    text = secrets.redacted(F.col("doc.text"), F.col("spans"))
    out = []
    for name in docs.columns:
        held = F.col("doc").getField(name)
        if name == "text":
            held = text
        elif name == "n_chars":
            held = F.when(hit, F.length(text).cast(docs.schema[name].dataType)).otherwise(held)
        out.append(held.alias(name))
    return found.select(*out)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of the sources at their weights: a row for each time a document is taken."""
    return mixing.mix(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of 2048 tokens, neighbours on the curve together."""
    return packing.pack(docs)
