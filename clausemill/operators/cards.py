"""Rule cards: one for each article with a body, classified by words and patterns."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as X
from ..schemas import MOST_STATEMENT


def extract(clauses: DataFrame) -> DataFrame:
    """clauses (clause_id, document_id, kind, citation, body) -> cards, invalid ones included, with their error."""
    rows = clauses.where(F.col("kind") == "dieu").withColumn("prose", X.without_header(F.col("body"))).where("prose <> ''")
    prose, cite = F.col("prose"), F.col("citation")
    topic = X.first_named(prose, X.TOPICS, None, X.TOPIC_NAMES)
    cards = rows.select(
        F.col("clause_id").alias("card_id"),
        "clause_id",
        "document_id",
        "citation",
        F.concat(cite, F.lit(": "), X.gloss(prose)).alias("statement"),
        X.first_named(prose, X.ACTORS, X.DEFAULT_ACTOR).alias("bound_actor"),
        F.when(topic.isNotNull(), F.array(topic)).otherwise(F.array().cast("array<string>")).alias("topic_tags"),
        F.array(F.concat(F.lit(X.FACT_PREFIX), cite)).alias("required_facts"),
        X.penalty(prose).alias("penalty"),
        F.md5("body").alias("body_md5"),
    )
    return validated(cards)


def validated(cards: DataFrame) -> DataFrame:
    return cards.withColumn("error", X.card_error(*[F.col(c) for c in ("statement", "bound_actor", "topic_tags", "required_facts", "penalty")], MOST_STATEMENT))


def of_document(cards: DataFrame, clauses: DataFrame) -> DataFrame:
    """Cards whose clause is still there, with its document."""
    live = clauses.select("clause_id", F.col("document_id").alias("d"))
    return cards.join(live, "clause_id").drop("document_id").withColumnRenamed("d", "document_id")


def counts(cards: DataFrame, clauses: DataFrame) -> DataFrame:
    return of_document(cards, clauses).groupBy("document_id").agg(F.count("*").alias("n"))


def stage_summary(units: DataFrame, done: DataFrame, cards: DataFrame) -> DataFrame:
    """One row: clauses scanned, cards inserted, units skipped, how many failed, ok; ``failures`` says which."""
    seen = units.join(done.select("clause_id").distinct().withColumn("skip", F.lit(True)), "clause_id", "left")
    rows = seen.join(cards.select("clause_id", "error", F.lit(True).alias("made")), "clause_id", "left")
    fresh = F.col("skip").isNull()
    per = rows.agg(
        F.count("*").alias("clauses_scanned"),
        F.count_if(fresh & F.col("made") & F.col("error").isNull()).alias("cards_inserted"),
        F.count_if(F.col("skip")).alias("skipped"),
        F.count_if(fresh & F.col("error").isNotNull()).alias("failed"),
    )
    return per.withColumn("ok", F.col("failed") == 0)


def failures(cards: DataFrame) -> DataFrame:
    return cards.where("error IS NOT NULL").select("clause_id", "error")


def of_clause(cards: DataFrame, clauses: DataFrame) -> DataFrame:
    """Each clause's cards by id, and whether they have a vector: clause_id, place, card_id, statement, has_embedding."""
    order = Window.partitionBy("clause_id").orderBy("card_id")
    mine = cards.join(clauses.select("clause_id"), "clause_id", "left_semi")
    return mine.select("clause_id", F.row_number().over(order).alias("place"), "card_id", "statement", F.col("embedding").isNotNull().alias("has_embedding"))


def embed_text(cards: DataFrame, clauses: DataFrame) -> DataFrame:
    """card_id and the text to embed; a missing clause leaves its part empty."""
    source = clauses.select("clause_id", F.col("citation").alias("cite"), F.col("body").alias("said"))
    both = cards.join(source, "clause_id", "left")
    text = F.concat("statement", F.lit("\n\nSource: "), F.coalesce("cite", F.lit("")), F.lit("\n"), F.coalesce("said", F.lit("")))
    return both.select("card_id", "clause_id", X.strip(text).alias("embed_text"))
