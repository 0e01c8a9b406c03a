"""The stages over a store: cards and embeddings of all documents, resumable."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from ..sources.scratch import held
from ..sources.store import Store, delete, pending
from . import cards as C
from . import vectors as V


def _of(df: DataFrame, document_id: int | None) -> DataFrame:
    return df if document_id is None else df.where(F.col("document_id") == document_id)


def rebuilt_marks(checkpoints: DataFrame, gone: DataFrame) -> DataFrame:
    """Checkpoints without those of cards and of embedding of the documents whose cards are made anew."""
    of_cards = F.col("stage").isin("cards", "embed")
    return checkpoints.where(~of_cards).unionByName(delete(checkpoints.where(of_cards), gone, ["document_id"]))


def run_cards(books: Store, document_id: int | None = None, rebuild: bool = False, extractor: Callable[[DataFrame], DataFrame] = C.extract) -> Row:
    """Cards of articles that have none for their present text; a summary row. A body that changed is read again.

    ``extractor`` turns clauses into cards with the columns of ``cards.extract``; another one may take its place.
    """
    clauses = _of(books.read("clauses"), document_id)
    if rebuild:
        with held(clauses.select("document_id", "clause_id")) as gone:
            books.patch("rule_cards", gone, lambda old: delete(old, gone, ["document_id"]))
            books.patch("checkpoints", gone, lambda old: rebuilt_marks(old, gone))
    units = clauses.where("kind = 'dieu'").withColumn("state", F.md5("body"))
    marks = books.read("checkpoints").where("stage = 'cards'").select(F.col("unit_id").alias("clause_id"), F.col("artifact_path").alias("state"), "status")
    with held(pending(units, marks, ["clause_id", "state"])) as todo, held(C.validated(extractor(todo).drop("error"))) as made:
        done = units.join(todo.select("clause_id"), "clause_id", "left_anti")
        summary = C.stage_summary(units, done, made).first()
        valid = made.where("error IS NULL").drop("error")
        marked = todo.join(made.select("clause_id", "error"), "clause_id", "left").select(
            "document_id", F.col("clause_id").alias("unit_id"), F.when(F.col("error").isNull(), "done").otherwise("failed").alias("status"), F.col("state").alias("artifact_path")
        )
        # Marks come from the clauses, which this doesn't change, so either write can be repeated.
        books.patch("rule_cards", todo, lambda old: old.join(todo.select("clause_id"), "clause_id", "left_anti").unionByName(valid, allowMissingColumns=True))
        books.mark(marked, "cards")
    return summary


def embed_summary(cards: DataFrame, vectors: DataFrame, dim: int) -> DataFrame:
    """One row for cards (card_id, skip) and the new vectors (card_id, embedding): scanned, embedded, skipped, dim, how many have
    another dimension (mismatched) or none (failed), and whether neither is so."""
    new = vectors.select("card_id", F.col("embedding").alias("v"), F.lit(True).alias("made"))
    size, fresh = F.size("v"), ~F.col("skip")
    rows = cards.select("card_id", "skip").join(new, "card_id", "left")
    per = rows.agg(
        F.count("*").alias("cards_scanned"),
        F.count_if(fresh & F.coalesce(size == dim, F.lit(False))).alias("embedded"),
        F.count_if(F.col("skip")).alias("skipped"),
        F.lit(dim).alias("dim"),
        F.count_if(fresh & F.col("v").isNotNull() & (size != dim)).alias("mismatched"),
        F.count_if(fresh & F.col("v").isNull()).alias("failed"),
    )
    return per.withColumn("ok", (F.col("mismatched") == 0) & (F.col("failed") == 0))


def to_embed(cards: DataFrame, checkpoints: DataFrame, dim: int, rebuild: bool = False) -> DataFrame:
    """cards (card_id, clause_id, embedding, ...) with ``skip``: done in the stage, and their vector has the dimension."""
    done = checkpoints.where("stage = 'embed' AND status = 'done'").select(F.col("unit_id").alias("clause_id"), F.lit(True).alias("done")).distinct()
    skip = F.coalesce("done", F.lit(False)) & F.coalesce(F.size("embedding") == dim, F.lit(False)) & F.lit(not rebuild)
    return cards.join(done, "clause_id", "left").withColumn("skip", skip).drop("done")


def run_embed(books: Store, encoder: V.Encoder, document_id: int | None = None, rebuild: bool = False) -> Row:
    """Vectors of cards that have none of the encoder's dimension: a summary row. Vectors of another dimension than the encoder names
    aren't stored, and their cards are left to be done again."""
    clauses = _of(books.read("clauses"), document_id)
    todo = to_embed(C.of_document(books.read("rule_cards"), clauses), books.read("checkpoints"), encoder.dim, rebuild)
    with held(todo) as cards, held(V.embed(C.embed_text(cards.where("NOT skip"), clauses), encoder).select("card_id", "clause_id", "embedding")) as new:
        summary = embed_summary(cards, new, encoder.dim).first()
        good = new.where(F.size("embedding") == encoder.dim)
        books.save_embeddings(good)
        units = cards.join(good.select("card_id", F.lit(True).alias("new")), "card_id", "left")
        status = F.when(F.col("skip") | F.coalesce("new", F.lit(False)), "done").otherwise("failed")
        books.mark(units.groupBy("document_id", F.col("clause_id").alias("unit_id")).agg(F.max(status).alias("status")), "embed")
    return summary


def check_dimensions(books: Store, expected: int, document_id: int | None = None) -> Row:
    cards = C.of_document(books.read("rule_cards"), _of(books.read("clauses"), document_id))
    return V.dimension_audit(cards, "card_id", expected).first()
