"""Hybrid retrieval: structural filters, then similarity, then a bounded top-k."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import vectors


def retrieve(
    cards: DataFrame,
    query: list[float],
    k: int = 10,
    *,
    document_id: int | None = None,
    article: str | None = None,
    actor: str | None = None,
    topic: str | None = None,
    penalty: bool | None = None,
) -> DataFrame:
    """The k cards most like a query vector among those that pass the filters, with their citation and score."""
    rows = cards.where(F.col("embedding").isNotNull())
    if document_id is not None:
        rows = rows.where(F.col("document_id") == document_id)
    if article is not None:
        rows = rows.where(F.col("citation") == f"Điều {article}")
    if actor is not None:
        rows = rows.where(F.col("bound_actor") == actor)
    if topic is not None:
        rows = rows.where(F.array_contains("topic_tags", topic))
    if penalty is not None:
        rows = rows.where(F.col("penalty").isNotNull() == penalty)
    wanted = F.array(*[F.lit(float(x)) for x in query])
    length = vectors.norm(F.col("embedding")) * vectors.norm(wanted)
    score = F.when(length > 0, vectors.dot(F.col("embedding"), wanted) / length).otherwise(F.lit(0.0))
    return rows.select("card_id", "clause_id", "document_id", "citation", "statement", score.alias("score")).orderBy(F.desc("score"), "card_id").limit(k)
