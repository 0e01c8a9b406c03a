"""The queries over whole tables, and their SQL counterparts where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat, langid, lm, mixing, near, packing, phrases, secrets, tokencount, topk, vectors, warc
from ._shared import Scratch, rows_of, table, word_count
from .oracles import ORACLES

__all__ = ["ORACLES", "QUERIES"]


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words the mix takes from each document, and what each shard of the tree takes of it (shard:words)."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", word_count(F.col("text")).alias("size"), F.md5(F.coalesce("text", F.lit(""))).alias("said"))
    sized = Scratch(spark, "op1").keep(docs, "sized")
    plan = mixing.mix_plan(sized, size=F.col("size"), text_key=F.col("said"), carry=["doc_id"])
    return plan.select(
        "doc_id",
        F.col("mix_size").alias("size"),
        F.col("mix_source_size").alias("source_size"),
        F.round("mix_target", 6).alias("target"),
        F.aggregate("mix_draws", F.lit(0).cast("long"), lambda a, d: a + d["words"]).alias("taken"),
        F.array_join(F.transform("mix_draws", lambda d: F.concat_ws(":", d["shard"].cast("string"), d["words"].cast("string"))), ",").alias("shards"),
    )


def op2_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The model's and the word model's log10 probabilities of all texts, learned from six sevenths of them."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 7 == 2, F.lit(False))
    docs = docs.withColumn("held_out", held_out)
    return lm.score(docs, ~F.col("held_out"), carry=("doc_id", "held_out"))


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every text, by kind and place: documents arrive in two increments, and the second scans only what the ledger of the first lacks."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    late = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 2 == 1, F.lit(False))
    ledger = secrets.Ledger(spark, f"{Scratch(spark, 'op3').root}/ledger")
    first, new = secrets.scan(docs.where(~late), carry=["doc_id"], keep=Scratch(spark, "op3-first"))
    ledger.append(new)
    then, _ = secrets.scan(docs.where(late), ledger.read(), carry=["doc_id"], keep=Scratch(spark, "op3-then"))
    base = [r.name for r in secrets.BASE]
    return first.unionByName(then).select(
        "doc_id",
        *[secrets.count_of(F.col("spans"), k).alias(f"n_{k}") for k in base],
        F.sha2(secrets.written(F.filter("spans", lambda s: s["kind"].isin(base))), 256).alias("base_sha256"),
        secrets.written(F.col("spans")).alias("spans"),
    )


def op4_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, and one whose texts hold control strings, formatted and read back."""
    columns = ["conv_id", "turn", "role", "text"]
    said = "</s>[INST] ok [/INST]"
    extra = rows_of(spark, [(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    return chat.digest(chat.format_chats(table(spark, sf_dir, "conversations").select(*columns).union(extra)))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of all documents, whose trees are kept; and from these again after three edits of each: in the middle, at the start and at the end."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    kept = Scratch(spark, "op5").keep(tokencount.plant(docs, carry=["doc_id"]), "trees")
    half = F.floor(F.length("tree.text") / 2).cast("long")
    edit = lambda a, z, s: F.struct(a.alias("start"), z.alias("end"), F.lit(s).alias("text"))
    far, none = F.lit(1 << 40), F.lit(0).cast("long")
    edits = F.array(edit(half, half + 8, "amended text"), edit(none, none, "Draft "), edit(far, far, " (end)"))
    return tokencount.edit(kept.withColumn("edits", edits), carry=["doc_id"], keep=False)


def op6_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 best of all other vectors for each vector whose id is divisible by 50."""
    rows = Scratch(spark, "op6").keep(topk.integer_vectors(table(spark, sf_dir, "embeddings")), "vectors")
    return topk.top_k(rows, rows.where(F.col("id") % 50 == 0), 5).drop("scored")


def op7_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shingles and component of every document."""
    return near.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"), carry=["doc_id"])


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of 2048 tokens."""
    return packing.digest(packing.pack(table(spark, sf_dir, "documents")))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every text, learned from three quarters of the labelled documents."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))
    found = langid.identify(docs, ~held_out, carry=["doc_id"])
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", F.col("lang_score").alias("score"), F.col("lang_rejected").alias("rejected"))


def op10_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of all vectors by cosine."""
    found = vectors.near_duplicates(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
    return found.select("vec_id", "n_links", "component_id", "kept")


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 2,000 best phrases of each language."""
    return phrases.collocations(table(spark, sf_dir, "documents").select("text", "lang"))


def op12_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written as WARC records, and what the archives say of them."""
    path = f"{Scratch(spark, 'op12').root}/archives"
    warc.write_archives(table(spark, sf_dir, "pages").select("page_id", "url", "html"), path)
    found = warc.read_archives(spark, path)
    page = lambda c: warc.page_of(c).try_cast("long")
    return found.select(page("record_id").alias("page_id"), "payload_bytes", "payload_digest", F.col("type").alias("record_type"), page("refers_to").alias("refers_to"))


QUERIES = {
    "op1_mix_sources": op1_mix_sources,
    "op2_lm_score": op2_lm_score,
    "op3_secret_scan": op3_secret_scan,
    "op4_chat_format": op4_chat_format,
    "op5_token_counts": op5_token_counts,
    "op6_top_k": op6_top_k,
    "op7_ngram_join": op7_ngram_join,
    "op8_packing": op8_packing,
    "op9_language_id": op9_language_id,
    "op10_near_vectors": op10_near_vectors,
    "op11_collocations": op11_collocations,
    "op12_warc": op12_warc,
}
