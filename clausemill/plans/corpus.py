"""The driver's tables as regulatory text: the same view in DataFrames and in SQL.

Every line of a document's text gets a prefix by its number, so that headers, references, chapters and
phrases of all kinds occur; eight lines make a page.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PHRASES = ("", "Hộ kinh doanh khai thuế; ", "Tổ chức lập hóa đơn bị phạt tiền theo mức. ", "Cá nhân giữ sổ sách. ")
CLAUSE_REF = "theo khoản 2 Điều 12. "
EXTERNAL_REF = "Theo Thông tư số 39/2014/TT-BTC và điểm a khoản 2 Điều 10 "
SELF_REF = "khoản 1 Điều này, điểm b khoản 1 Điều này và điểm c Điều 7 "


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """document_id, page, line_no, line."""
    docs = table(spark, sf_dir, "documents").where("text IS NOT NULL AND doc_id IS NOT NULL")
    return lines_of(docs.select(F.col("doc_id").alias("document_id"), "text"))


def lines_of(docs: DataFrame) -> DataFrame:
    """docs (document_id, text) -> document_id, page, line_no, line."""
    rows = docs.select("document_id", F.posexplode(F.split("text", "\n", -1)).alias("line_no", "said"))
    n, group = F.col("line_no"), F.expr("line_no div 6")
    phrase = F.element_at(F.array(*map(F.lit, PHRASES)), (group % 4 + 1).cast("int"))
    number = (group + 1 + F.expr("line_no div 36")).cast("string")
    prefix = (
        F.when(n % 6 == 0, F.concat(F.lit("Điều "), number, F.lit(". "), phrase))
        .when(n % 6 == 1, "Khoản 1. ")
        .when(n % 6 == 2, "    a) ")
        .when(n % 6 == 3, CLAUSE_REF)
        .when(n % 6 == 4, EXTERNAL_REF)
        .otherwise(F.when(group % 5 == 4, "Chương II ").otherwise(SELF_REF))
    )
    return rows.select("document_id", F.expr("cast(1 + line_no div 8 AS INT)").alias("page"), "line_no", F.concat(prefix, F.col("said")).alias("line"))


LINES_SQL = f"""
lines AS (
  SELECT document_id, (1 + n // 8)::INTEGER AS page, n AS line_no,
         CASE n % 6
           WHEN 0 THEN 'Điều ' || (n // 6 + 1 + n // 36) || '. ' || CASE (n // 6) % 4 WHEN 0 THEN '{PHRASES[0]}' WHEN 1 THEN '{PHRASES[1]}' WHEN 2 THEN '{PHRASES[2]}' ELSE '{PHRASES[3]}' END
           WHEN 1 THEN 'Khoản 1. ' WHEN 2 THEN '    a) ' WHEN 3 THEN '{CLAUSE_REF}' WHEN 4 THEN '{EXTERNAL_REF}'
           ELSE CASE WHEN (n // 6) % 5 = 4 THEN 'Chương II ' ELSE '{SELF_REF}' END END || said AS line
  FROM (SELECT document_id, unnest(s) AS said, unnest(range(0, len(s))) AS n
        FROM (SELECT doc_id AS document_id, string_split(text, chr(10)) AS s FROM documents WHERE text IS NOT NULL AND doc_id IS NOT NULL))
)"""
