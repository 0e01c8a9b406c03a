"""JSON artifacts, one line for each document: the clause graph and the cards."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.clauses import parent_numbers

_CLAUSE = ("kind", "number", "citation", "page_start", "page_end", "body", "parent_number", "ord")
GRAPH = (
    "document_id long, page_count int, clauses array<struct<kind:string,number:string,citation:string,page_start:int,page_end:int,body:string,"
    "parent_number:array<string>,ord:int,id:long>>"
)
CARDS = "document_id long, card_count long, cards array<struct<id:long,clause_id:long,statement:string,has_embedding:boolean>>"


def _json(df: DataFrame, *columns: str) -> DataFrame:
    return df.select("document_id", F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}).alias("json"))


def clause_graphs(pages: DataFrame, parsed: DataFrame, clauses: DataFrame) -> DataFrame:
    """document_id, json: every clause that was parsed, in order, with the id that its citation has in the table; of documents with a page."""
    ids = clauses.select("document_id", "citation", F.col("clause_id").alias("id"))
    each = parent_numbers(parsed).join(ids, ["document_id", "citation"], "left")
    per = each.groupBy("document_id").agg(F.sort_array(F.collect_list(F.struct("ord", F.struct(*_CLAUSE, "id").alias("c")))).alias("all"))
    count = pages.groupBy("document_id").agg(F.max("page").cast("int").alias("page_count"))
    none = F.array().cast("array<struct<kind:string,number:string,citation:string,page_start:int,page_end:int,body:string,parent_number:array<string>,ord:int,id:bigint>>")
    return _json(count.join(per, "document_id", "left").withColumn("clauses", F.coalesce(F.col("all.c"), none)), "document_id", "page_count", "clauses")


def card_files(documents: DataFrame, cards: DataFrame) -> DataFrame:
    """document_id, json of every document: its cards (card_id, clause_id, statement, embedding) by id; cards have a document_id."""
    card = F.struct(F.col("card_id").alias("id"), "clause_id", "statement", F.col("embedding").isNotNull().alias("has_embedding"))
    per = cards.groupBy("document_id").agg(F.sort_array(F.collect_list(card)).alias("all"))
    rows = documents.select("document_id").join(per, "document_id", "left")
    none = F.array().cast("array<struct<id:bigint,clause_id:bigint,statement:string,has_embedding:boolean>>")
    rows = rows.withColumn("cards", F.coalesce("all", none)).withColumn("card_count", F.size("cards").cast("long"))
    return _json(rows, "document_id", "card_count", "cards")


def write(artifacts: DataFrame, path: str, name: str) -> None:
    """Files under path/name, instead of those that are there; each line names its document."""
    artifacts.select(F.col("json").alias("value")).write.mode("overwrite").text(f"{path}/{name}")


def read(spark: SparkSession, path: str, name: str, schema: str) -> DataFrame:
    rows = spark.read.text(f"{path}/{name}").select(F.from_json("value", schema).alias("r"))
    return rows.select("r.*")
