"""Cards as variants: one column of whatever fields a card's generation had, read by paths.

A field that older cards lack is null where it is asked for, so cards of all generations are read in one plan, and none is rewritten when
a field is added. Spark's Parquet files keep the variant as it is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

STORED = "card_id long, document_id long, card variant, raw string, generation int"
#: What a reader gets, by path and type; older generations lack the lower ones.
FIELDS = {
    "citation": ("$.citation", "string"),
    "statement": ("$.statement", "string"),
    "bound_actor": ("$.actor", "string"),
    "penalty": ("$.penalty", "string"),
    "topic_tags": ("$.topics", "array<string>"),
    "required_facts": ("$.facts", "array<string>"),
    "page_start": ("$.source.pages[0]", "int"),
    "page_end": ("$.source.pages[1]", "int"),
}


def written_as(cards: DataFrame, generation: int) -> DataFrame:
    """cards -> card_id, document_id, json of the fields that a generation has, generation. The second added topics, facts and the source."""
    old = [F.col("citation"), F.col("statement"), F.col("bound_actor").alias("actor"), F.col("penalty")]
    new = [F.col("topic_tags").alias("topics"), F.col("required_facts").alias("facts"), F.struct(F.array("page_start", "page_end").alias("pages")).alias("source")]
    return cards.select("card_id", "document_id", F.to_json(F.struct(*old, *(new if generation > 1 else []))).alias("json"), F.lit(generation).alias("generation"))


def write_cards(rows: DataFrame, path: str) -> None:
    """rows (card_id, document_id, json, generation) under a path, by generation; those of the generations in rows are replaced. Text that is no JSON stays as ``raw``."""
    card = F.try_parse_json("json")
    made = rows.select("card_id", "document_id", card.alias("card"), F.when(card.isNull(), F.col("json")).alias("raw"), F.col("generation").cast("int").alias("generation"))
    made.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("generation").parquet(path)


def read_cards(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(STORED).parquet(path)


def field(name: str, card: str = "card") -> Column:
    """A field of FIELDS; null where the card lacks it, or has something of another kind there."""
    path, kind = FIELDS[name]
    return F.try_variant_get(F.col(card), path, kind).alias(name)


def with_fields(cards: DataFrame, *names: str) -> DataFrame:
    """card_id, document_id, generation and the named fields (all, by default)."""
    return cards.select("card_id", "document_id", "generation", *[field(n) for n in names or FIELDS])


def schemas(cards: DataFrame) -> DataFrame:
    """generation, cards, schema: what the cards of each generation have in common, as Spark sees it."""
    return cards.groupBy("generation").agg(F.count("card").alias("cards"), F.schema_of_variant_agg("card").alias("schema"))
