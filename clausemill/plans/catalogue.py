"""The registered queries and their SQL counterparts.

"""

from __future__ import annotations

import atexit
import re
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import blake2
from ..functions import text as X
from ..operators import asof
from ..operators import cards as C
from ..operators import clauses as K
from ..operators import graph as G
from ..operators import index as I
from ..operators import instruments as N
from ..operators import patches
from ..operators import quality as Q
from ..operators import references as R
from ..operators import retrieve as H
from ..operators import stages, variants
from ..operators import vectors as V
from ..schemas import DEFAULT_DIM
from ..sources import artifacts, markup, ocr, rasterise, store
from ..sources.scratch import delete_folder, shared_folder, written
from ..streaming import articles
from . import sql as S
from .corpus import lines, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def written_to(spark: SparkSession) -> str:
    """A folder for artifacts, which goes when the driver ends."""
    path = f"{shared_folder(spark)}/artifacts-{uuid.uuid4().hex}"
    atexit.register(delete_folder, spark, path)
    return path


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return register


def _clauses(spark, sf_dir):
    return K.stored(K.parse_lines(lines(spark, sf_dir)))


def _parsed(spark, sf_dir):
    """Parsed clauses and those to store, as tables: for plans that read them in several branches."""
    parsed = written(K.parse_lines(lines(spark, sf_dir)), "parsed")
    return parsed, written(K.stored(parsed), "clauses")


def _cited(spark, sf_dir):
    """As ``_parsed``, with what the texts refer to in place of the texts, for plans that need no more of them."""
    parsed = written(R.found(K.parse_lines(lines(spark, sf_dir))), "parsed")
    return parsed, written(K.stored(parsed), "clauses")


def _references(spark, sf_dir):
    parsed, kept = _cited(spark, sf_dir)
    return R.resolve(R.extract(parsed), kept)


# ---- clauses


@query(S.lines_up(S.PARSED_SQL, select="SELECT document_id, kind, count(*) AS n FROM parsed GROUP BY ALL"))
def clause_kind_counts(spark, sf_dir):
    """H1-H4, W1, W5, G1."""
    return K.kind_counts(K.parse_lines(lines(spark, sf_dir)))


@query(S.lines_up(S.PARSED_SQL, S.STORED_SQL, select="SELECT clause_id, document_id, parent_id, kind, number, citation, page_start, page_end, ord FROM clauses"))
def clause_tree(spark, sf_dir):
    """H5, W2, W7, J6, U2, B9."""
    return _clauses(spark, sf_dir).select("clause_id", "document_id", "parent_id", "kind", "number", "citation", "page_start", "page_end", "ord")


@query(S.lines_up(S.PARSED_SQL, select="SELECT document_id, ord, md5(body) AS body_md5, length(body)::INTEGER AS body_chars, page_end FROM parsed"))
def clause_bodies(spark, sf_dir):
    """W4, G10, G11, G12, H7, H8, J12."""
    rows = K.parse_lines(lines(spark, sf_dir))
    return rows.select("document_id", "ord", F.md5("body").alias("body_md5"), F.length("body").alias("body_chars"), "page_end")


@query(
    S.lines_up(S.PARSED_SQL, S.STORED_SQL, select="SELECT parent_id, clause_id, row_number() OVER (PARTITION BY parent_id ORDER BY ord)::INTEGER AS place FROM clauses WHERE parent_id IS NOT NULL")
)
def clause_children(spark, sf_dir):
    """B10 for every clause."""
    rows = _clauses(spark, sf_dir).where("parent_id IS NOT NULL")
    return rows.select("parent_id", "clause_id", F.row_number().over(Window.partitionBy("parent_id").orderBy("ord")).alias("place"))


@query(S.lines_up(S.PARSED_SQL, select="SELECT document_id, ord, CASE WHEN kind = 'dieu' OR dieu IS NULL THEN NULL WHEN kind = 'diem' AND khoan IS NOT NULL THEN dieu || '/' || khoan ELSE dieu END AS ancestors FROM parsed"))
def clause_ancestor_numbers(spark, sf_dir):
    """H6."""
    rows = K.parent_numbers(K.parse_lines(lines(spark, sf_dir)))
    return rows.select("document_id", "ord", F.when(F.col("parent_number").isNotNull(), F.array_join("parent_number", "/")).alias("ancestors"))


@query(S.lines_up(S.PARSED_SQL, S.STORED_SQL, select="SELECT document_id, string_agg(number, ',' ORDER BY ord) AS numbers FROM clauses WHERE kind = 'dieu' GROUP BY document_id"))
def article_numbers(spark, sf_dir):
    """B13, G10."""
    rows = _clauses(spark, sf_dir).where("kind = 'dieu'")
    ordered = F.array_sort(F.collect_list(F.struct("ord", "number")))
    return rows.groupBy("document_id").agg(F.array_join(F.transform(ordered, lambda x: x["number"]), ",").alias("numbers"))


@query(S.lines_up(select="SELECT document_id, max(page)::INTEGER AS page_count, count(DISTINCT page) AS pages_with_text FROM lines GROUP BY document_id"))
def page_counts(spark, sf_dir):
    """G3, A11."""
    return lines(spark, sf_dir).groupBy("document_id").agg(F.max("page").alias("page_count"), F.countDistinct("page").alias("pages_with_text"))


@query(
    S.lines_up(
        """placed AS (
          SELECT *, coalesce(sum(length(line) + 1) OVER (PARTITION BY document_id ORDER BY line_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start FROM lines
        ), starts AS (SELECT document_id, page, min(start) AS start FROM placed GROUP BY ALL
        ), found AS (SELECT document_id, start, CASE WHEN regexp_matches(line, '%s') THEN 'dieu' WHEN regexp_matches(line, '%s') THEN 'khoan' WHEN regexp_matches(line, '%s') THEN 'diem' END AS kind, page FROM placed)"""
        % (X.DIEU, X.KHOAN, X.DIEM),
        select='SELECT f.document_id, f.start AS "offset", f.kind, s.page, s.page = f.page AS same FROM (SELECT * FROM found WHERE kind IS NOT NULL) f ASOF JOIN starts s ON s.document_id = f.document_id AND f.start >= s.start',
    )
)
def pages_of_offsets(spark, sf_dir):
    """The page of each header by its offset in the document's text, as-of the pages' starts; the same as by lines."""
    rows = written(lines(spark, sf_dir), "lines")
    ordered = F.array_sort(F.collect_list(F.struct("line_no", "line")))
    pages = rows.groupBy("document_id", F.col("page").alias("page_ordinal")).agg(F.array_join(F.transform(ordered, lambda x: x["line"]), "\n").alias("raw_text"))
    found = asof.pages_at(asof.header_offsets(rows), asof.page_starts(pages))
    return found.select("document_id", "offset", "kind", "page", (F.col("page") == F.col("line_page")).alias("same"))


# ---- references

_REFS = (S.PARSED_SQL, S.STORED_SQL, S.EXTRACTED_SQL, S.RESOLVED_SQL)


@query(S.lines_up(S.PARSED_SQL, S.EXTRACTED_SQL, select="SELECT document_id, ord, no::INTEGER AS place, kind, raw_text, target_citation FROM extracted WHERE kind <> 'external'"))
def refs_internal(spark, sf_dir):
    """H9-H14, H16, H17, F4, W6, S1, S2."""
    rows = R.extract(K.parse_lines(lines(spark, sf_dir)))
    return rows.where("kind <> 'external'").select("document_id", "ord", "place", "kind", "raw_text", "target_citation")


@query(S.lines_up(S.PARSED_SQL, S.EXTRACTED_SQL, select="SELECT document_id, ord, raw_text, target_citation FROM extracted WHERE kind = 'external'"))
def refs_external(spark, sf_dir):
    """H15."""
    rows = R.extract(K.parse_lines(lines(spark, sf_dir)))
    return rows.where("kind = 'external'").select("document_id", "ord", "raw_text", "target_citation")


@query(S.lines_up(*_REFS, select="SELECT document_id, src_clause_id, dst_clause_id, kind, raw_text, target_citation FROM refs"))
def refs_resolved(spark, sf_dir):
    """H18, J7, U3."""
    return _references(spark, sf_dir).select("document_id", "src_clause_id", "dst_clause_id", "kind", "raw_text", "target_citation")


@query(S.lines_up(*_REFS, select="SELECT document_id, src_clause_id, raw_text, target_citation FROM refs WHERE dst_clause_id IS NULL"))
def refs_dangling(spark, sf_dir):
    """J1, J4."""
    return R.dangling(_references(spark, sf_dir)).select("document_id", "src_clause_id", "raw_text", "target_citation")


@query(S.lines_up(*_REFS, select="SELECT document_id, dst_clause_id, count(*) AS n FROM refs WHERE dst_clause_id IS NOT NULL GROUP BY ALL"))
def refs_in_degree(spark, sf_dir):
    """B11."""
    return R.in_degrees(_references(spark, sf_dir))


@query(
    S.lines_up(
        *_REFS,
        select="""SELECT p.document_id, p.pages, coalesce(c.clauses, 0) AS clauses, coalesce(c.stored, 0) AS clauses_stored, coalesce(e.n, 0) AS refs_extracted,
                  coalesce(r.internal, 0) AS refs_internal, coalesce(r.ext, 0) AS refs_external
           FROM (SELECT document_id, max(page)::INTEGER AS pages FROM lines GROUP BY 1) p
           LEFT JOIN (SELECT document_id, count(*) AS clauses, count(DISTINCT citation) AS stored FROM parsed GROUP BY 1) c USING (document_id)
           LEFT JOIN (SELECT document_id, count(*) AS n FROM extracted GROUP BY 1) e USING (document_id)
           LEFT JOIN (SELECT document_id, count(*) FILTER (WHERE kind = 'internal') AS internal, count(*) FILTER (WHERE kind = 'external') AS ext FROM refs GROUP BY 1) r USING (document_id)""",
    )
)
def structure_summary(spark, sf_dir):
    """G3, G4."""
    parsed, kept = _cited(spark, sf_dir)
    extracted = written(R.extract(parsed), "extracted")
    return R.summary(lines(spark, sf_dir), parsed, extracted, R.resolve(extracted, kept))


# ---- cards


@query(
    S.lines_up(
        S.PARSED_SQL, S.STORED_SQL, S.CARDS_SQL, select="SELECT card_id, document_id, statement, bound_actor, coalesce(topic, '') AS topics, fact AS facts, penalty FROM cards"
    )
)
def cards(spark, sf_dir):
    """H24-H29, F6, U5."""
    rows = C.extract(_clauses(spark, sf_dir))
    return rows.select("card_id", "document_id", "statement", "bound_actor", F.array_join("topic_tags", ",").alias("topics"), F.array_join("required_facts", ",").alias("facts"), "penalty")


@query(S.lines_up(S.PARSED_SQL, S.STORED_SQL, S.CARDS_SQL, select="SELECT topic, bound_actor, count(*) AS n, count(penalty) AS penalties FROM cards GROUP BY topic, bound_actor"))
def card_topics(spark, sf_dir):
    """H26-H28."""
    rows = C.extract(_clauses(spark, sf_dir))
    return rows.groupBy(F.get("topic_tags", F.lit(0)).alias("topic"), "bound_actor").agg(F.count("*").alias("n"), F.count("penalty").alias("penalties"))


@query(S.lines_up(S.PARSED_SQL, S.STORED_SQL, S.CARDS_SQL, select="SELECT document_id, count(*) AS n FROM cards GROUP BY document_id"))
def cards_per_doc(spark, sf_dir):
    """J2, J3, G2."""
    kept = _clauses(spark, sf_dir)
    return C.counts(C.extract(kept), kept)


@query(
    f"""SELECT conv_id, turn, CASE WHEN text IS NULL OR {S.STRIP("text")} = '' THEN 'statement is blank' WHEN length(text) > 600 THEN 'statement is too long'
        WHEN role IS NULL OR {S.STRIP("role")} = '' THEN 'bound_actor is blank' WHEN turn % 3 = 2 THEN 'penalty is blank' END AS error FROM conversations"""
)
def card_validation(spark, sf_dir):
    """Turns as statements and roles as actors, every third with a blank penalty."""
    rows = table(spark, sf_dir, "conversations")
    names = F.array(F.lit("x"))
    fine = F.when(F.col("turn") % 3 == 2, " ").when(F.col("turn") % 3 == 1, "phạt")
    return rows.select("conv_id", "turn", X.card_error(F.col("text"), F.col("role"), names, names, fine).alias("error"))


@query(
    S.lines_up(
        S.PARSED_SQL,
        S.STORED_SQL,
        S.CARDS_SQL,
        select=f"SELECT card_id, md5({S.STRIP('statement || chr(10) || chr(10) || ' + chr(39) + 'Source: ' + chr(39) + ' || citation || chr(10) || body')}) AS text_md5 FROM cards",
    )
)
def embed_text(spark, sf_dir):
    """H36, J8."""
    kept = _clauses(spark, sf_dir)
    return C.embed_text(C.extract(kept), kept).select("card_id", F.md5("embed_text").alias("text_md5"))


# ---- vectors


@query("WITH " + S.BAG_SQL + "SELECT doc_id, token, count(*) AS n FROM tokens GROUP BY ALL")
def token_counts(spark, sf_dir):
    """H31, G8."""
    return V.token_counts(table(spark, sf_dir, "documents"), "doc_id", "text")


@query(
    "WITH "
    + S.BAG_SQL
    + f""", bag AS (SELECT doc_id, (('0x' || substr(md5(token), 1, 8))::BIGINT % {DEFAULT_DIM})::INTEGER AS bucket, count(*) AS n FROM tokens GROUP BY ALL)
    SELECT doc_id, bucket, n, round(n / sqrt(sum((n * n)::DOUBLE) OVER (PARTITION BY doc_id)), 6) AS weight FROM bag"""
)
def hashed_bag(spark, sf_dir):
    """G8, G9, H32-H34, with an MD5 bucket."""
    rows = V.hashed_bag(table(spark, sf_dir, "documents"), "doc_id", "text")
    return rows.select("doc_id", "bucket", "n", F.round("weight", 6).alias("weight"))


@query("SELECT vec_id, round(sqrt(list_sum(list_transform(embedding, lambda x: x::DOUBLE * x::DOUBLE))), 6) AS norm, len(embedding)::INTEGER AS dim FROM embeddings")
def vector_norms(spark, sf_dir):
    """G9, H33."""
    return table(spark, sf_dir, "embeddings").select("vec_id", F.round(V.norm(F.col("embedding")), 6).alias("norm"), F.size("embedding").alias("dim"))


@query(
    """SELECT count(*) AS checked, count(*) FILTER (WHERE len(embedding) <> 128) AS mismatched, count(*) FILTER (WHERE len(embedding) <> 128) = 0 AS ok
       FROM embeddings WHERE embedding IS NOT NULL"""
)
def dim_audit(spark, sf_dir):
    """G7, with a wrong expectation."""
    found = V.dimension_audit(table(spark, sf_dir, "embeddings"), "vec_id", 128)
    return found.select("checked", "mismatched", "ok")


@query(
    """WITH q AS (SELECT embedding AS e FROM embeddings WHERE vec_id = 0)
       SELECT vec_id, round(list_dot_product(embedding::DOUBLE[], e::DOUBLE[]) / sqrt(list_dot_product(embedding::DOUBLE[], embedding::DOUBLE[]) * list_dot_product(e::DOUBLE[], e::DOUBLE[])), 6) AS cosine
       FROM embeddings, q WHERE embedding IS NOT NULL ORDER BY 2 DESC, 1 LIMIT 10"""
)
def cosine_topk(spark, sf_dir):
    """the ten vectors most like the first."""
    rows = table(spark, sf_dir, "embeddings")
    first = rows.where("vec_id = 0").first()
    wanted = [float(x) for x in first["embedding"]] if first else []
    rows = rows if first else rows.limit(0)
    return V.most_similar(rows, "vec_id", wanted, 10).select("vec_id", F.round("cosine", 6).alias("cosine"))


@query(
    "WITH RECURSIVE "
    + S.BAG_SQL.strip()
    + ", "
    + blake2.bucket_sql("tokens", DEFAULT_DIM).strip()
    + """, bag AS (SELECT doc_id, bucket, count(*) AS n FROM tokens JOIN hashed USING (token) GROUP BY ALL)
    SELECT doc_id, bucket, n, round(n / sqrt(sum((n * n)::DOUBLE) OVER (PARTITION BY doc_id)), 6) AS weight FROM bag"""
)
def blake2_bag(spark, sf_dir):
    """The bag of the hashing encoder; the SQL works the digests out on numbers beyond 64 bits."""
    rows = V.encoder_bag(table(spark, sf_dir, "documents").where("text IS NOT NULL"), "doc_id", "text", V.HashBag(DEFAULT_DIM))
    return rows.select("doc_id", "bucket", "n", F.round("weight", 6).alias("weight"))


@query()
def blake2_embed(spark, sf_dir):
    """float32 bytes have no SQL; a test holds them to blake2_bag, which has."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    made = V.to_bytes(V.embed(docs, V.HashBag(DEFAULT_DIM), "text"), DEFAULT_DIM)
    return made.select("doc_id", F.size("embedding").alias("dim"), F.length("embedding_bytes").alias("bytes"), F.md5("embedding_bytes").alias("md5"))


# ---- quality


@query(S.lines_up(S.PARSED_SQL, S.STORED_SQL, S.ARTICLES_SQL, select="SELECT document_id, first_missing, last_missing, before_ord, after_ord FROM numbering"))
def numbering_gaps(spark, sf_dir):
    """S3, J14, G13, H20, Q-d."""
    return Q.numbering_gaps(_clauses(spark, sf_dir)).select("document_id", "first_missing", "last_missing", "before_ord", "after_ord")


@query(S.lines_up(S.PARSED_SQL, S.STORED_SQL, S.ARTICLES_SQL, select="SELECT document_id, first_missing, last_missing, by_chapter FROM numbering"))
def chapter_gaps(spark, sf_dir):
    """H19, J13, W3."""
    _, kept = _parsed(spark, sf_dir)
    return Q.numbering_gaps(kept, lines(spark, sf_dir)).select("document_id", "first_missing", "last_missing", "by_chapter")


@query(
    S.lines_up(
        *_REFS,
        S.ARTICLES_SQL,
        select=f"""SELECT d.doc_id AS document_id, coalesce(i.n, 0) + (c.n IS NULL)::BIGINT = 0 AS ok, coalesce(i.n, 0) + (c.n IS NULL)::BIGINT AS issues, coalesce(g.n, 0) AS notes
        FROM documents d
        LEFT JOIN (SELECT document_id, count(*) AS n FROM clauses GROUP BY 1) c ON c.document_id = d.doc_id
        LEFT JOIN (SELECT document_id, count(*) AS n FROM clauses WHERE {S.STRIP("body")} = '' GROUP BY 1) i ON i.document_id = d.doc_id
        LEFT JOIN (SELECT document_id, 1::BIGINT AS n FROM numbering WHERE NOT by_chapter GROUP BY 1) g ON g.document_id = d.doc_id""",
    )
)
def invariant_issues(spark, sf_dir):
    """Q-a to Q-f."""
    parsed, kept = _parsed(spark, sf_dir)
    documents = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("document_id"))
    return Q.report(documents, Q.check(documents, kept, R.resolve(R.extract(parsed), kept), lines(spark, sf_dir)))


# ---- store


@query("SELECT d.doc_id, d.source FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id AND l.quality = 1)")
def pending_units(spark, sf_dir):
    """Documents are units, labels of quality 1 are done checkpoints."""
    done = table(spark, sf_dir, "labels").select(F.col("doc_id"), F.when(F.col("quality") == 1, "done").otherwise("failed").alias("status"))
    return store.pending(table(spark, sf_dir, "documents").select("doc_id", "source"), done, ["doc_id"])


@query("SELECT DISTINCT doc_id FROM labels WHERE quality = 1 AND doc_id > 0")
def completed_units(spark, sf_dir):
    """Done, and not the marker 0."""
    marks = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("unit_id"), F.when(F.col("quality") == 1, "done").otherwise("failed").alias("status"))
    return store.completed(marks).select(F.col("unit_id").alias("doc_id"))


@query(
    """SELECT user_id, event_type, event_id, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS k FROM events) WHERE k = 1"""
)
def upsert_last_wins(spark, sf_dir):
    """The last event of each user and type."""
    rows = table(spark, sf_dir, "events")
    return store.upsert(rows.limit(0), rows, ["user_id", "event_type"], ["ts", "event_id"]).select("user_id", "event_type", "event_id", "value")


@query("SELECT conv_id, role, turn, md5(coalesce(text, '')) AS text_md5 FROM (SELECT *, row_number() OVER (PARTITION BY conv_id, role ORDER BY turn) AS k FROM conversations) WHERE k = 1")
def insert_ignore_first_wins(spark, sf_dir):
    """The first turn of each role."""
    rows = table(spark, sf_dir, "conversations")
    kept = store.insert_ignore(rows.limit(0), rows, ["conv_id", "role"], ["turn"])
    return kept.select("conv_id", "role", "turn", F.md5(F.coalesce("text", F.lit(""))).alias("text_md5"))


@query("SELECT DISTINCT ON (source) source, min(doc_id) OVER (PARTITION BY source) AS document_id FROM documents")
def ensure_documents(spark, sf_dir):
    """One document for each source path, the existing one first."""
    rows = table(spark, sf_dir, "documents").select("source", F.col("doc_id").alias("document_id"))
    have = rows.where("document_id < 100")
    return store.insert_ignore(have.groupBy("source").agg(F.min("document_id").alias("document_id")), rows, ["source"], ["document_id"])


@query(
    S.lines_up(
        S.PARSED_SQL,
        S.STORED_SQL,
        S.EXTRACTED_SQL,
        S.RESOLVED_SQL,
        select="SELECT document_id, src_clause_id, count(*) AS n FROM refs WHERE document_id NOT IN (SELECT doc_id FROM labels WHERE toxic = 1) GROUP BY ALL",
    )
)
def delete_document_graph(spark, sf_dir):
    """References without those of deleted documents."""
    gone = table(spark, sf_dir, "labels").where("toxic = 1").select(F.col("doc_id").alias("document_id"))
    kept = store.delete(_references(spark, sf_dir), gone, ["document_id"])
    return kept.groupBy("document_id", "src_clause_id").agg(F.count("*").alias("n"))


@query(
    """SELECT e.vec_id, CASE WHEN l.quality = 1 THEN 'new' WHEN e.label % 2 = 0 THEN 'old' END AS embedding FROM embeddings e LEFT JOIN labels l ON l.doc_id = e.vec_id"""
)
def update_embeddings(spark, sf_dir):
    """New values where there are some, the old ones elsewhere."""
    rows = table(spark, sf_dir, "embeddings").select("vec_id", F.when(F.col("label") % 2 == 0, "old").alias("embedding"))
    new = table(spark, sf_dir, "labels").where("quality = 1").select(F.col("doc_id").alias("vec_id"), F.lit("new").alias("embedding"))
    return store.update(rows, new, ["vec_id"], ["embedding"])


# ---- import, OCR records, HTTP


@query(markup.PAGE_IMPORT_SQL)
def page_import(spark, sf_dir):
    """Each document's lines as one marked-up file."""
    return markup.page_import_query(table(spark, sf_dir, "documents"))


@query(markup.CLEAN_SQL)
def markup_clean(spark, sf_dir):
    """Markup put around the lines of web pages, and taken out again."""
    return markup.clean_query(table(spark, sf_dir, "pages"))


@query(ocr.SSE_SQL)
def sse_decode(spark, sf_dir):
    """Turns as the events of a stream."""
    return ocr.sse_query(table(spark, sf_dir, "conversations"))


@query(ocr.ROUNDTRIP_SQL)
def ocr_json_roundtrip(spark, sf_dir):
    """Turns as page records, written as JSON and read again."""
    return ocr.roundtrip_query(table(spark, sf_dir, "conversations"))


@query(
    """SELECT doc_id, '[stub OCR] page=' || (n_chars % 9 + 1) || ' image=' || regexp_extract('out/doc' || doc_id || '/page' || lpad((n_chars % 9 + 1)::VARCHAR, 4, '0') || '.png', '[^/]*$') AS raw_text,
       'out/ocr/doc' || doc_id || '/page' || lpad((n_chars % 9 + 1)::VARCHAR, 4, '0') || '.json' AS artifact FROM documents"""
)
def stub_ocr(spark, sf_dir):
    """The stub backend over registered pages."""
    page = (F.col("n_chars") % 9 + 1).cast("int")
    rows = table(spark, sf_dir, "documents").select("doc_id", page.alias("page_ordinal"), X.page_image_path(F.lit("out"), F.col("doc_id"), page).alias("image_path"))
    return rows.select("doc_id", ocr.stub_text(F.col("page_ordinal"), F.col("image_path")).alias("raw_text"), X.artifact_path(F.lit("out"), F.col("doc_id"), F.col("page_ordinal")).alias("artifact"))


@query("SELECT page_id, 'data:image/' || CASE WHEN lower(url) LIKE '%.png' THEN 'png' ELSE 'jpeg' END || ';base64,' || base64(encode(html)) AS data_url FROM pages")
def image_data_urls(spark, sf_dir):
    """A16."""
    rows = table(spark, sf_dir, "pages")
    return rows.select("page_id", X.image_data_url(F.col("url"), F.encode("html", "UTF-8")).alias("data_url"))


@query("SELECT conv_id, md5(string_agg(coalesce(text, '') || chr(10), '' ORDER BY turn)) AS text_md5, max(turn) AS last_turn FROM conversations GROUP BY conv_id")
def ordered_concat(spark, sf_dir):
    """G10, F1, F2."""
    rows = table(spark, sf_dir, "conversations")
    ordered = F.array_sort(F.collect_list(F.struct("turn", F.coalesce("text", F.lit("")).alias("text"))))
    text = F.array_join(F.transform(ordered, lambda x: F.concat(x["text"], F.lit("\n"))), "")
    return rows.groupBy("conv_id").agg(F.md5(text).alias("text_md5"), F.max("turn").alias("last_turn"))


@query(rasterise.RANGES_SQL)
def page_ranges(spark, sf_dir):
    """Every document as a book that is cut into ranges of pages, each rendered in a task of its own."""
    return rasterise.ranges_query(table(spark, sf_dir, "documents").select("doc_id", "text"))


# ---- graph and retrieval


@query(
    S.lines_up(
        S.PARSED_SQL,
        S.STORED_SQL,
        "walk AS (SELECT clause_id, clause_id AS ancestor_id, parent_id AS above, 0 AS depth FROM clauses UNION ALL SELECT w.clause_id, c.clause_id, c.parent_id, w.depth + 1 FROM walk w JOIN clauses c ON c.clause_id = w.above)",
        select="SELECT clause_id, ancestor_id, depth FROM walk",
    )
)
def ancestor_walk(spark, sf_dir):
    """M2: parents, transitively."""
    return G.ancestors(_parsed(spark, sf_dir)[1])


@query(
    S.lines_up(
        *_REFS,
        "hop AS (SELECT DISTINCT src_clause_id AS src, dst_clause_id AS dst FROM refs WHERE dst_clause_id IS NOT NULL)",
        "walk AS (SELECT clause_id AS start_id, clause_id, 0 AS hops FROM clauses WHERE kind = 'dieu' UNION SELECT w.start_id, h.dst, w.hops + 1 FROM walk w JOIN hop h ON h.src = w.clause_id WHERE w.hops < 2)",
        select="SELECT start_id, clause_id, min(hops)::INTEGER AS hops FROM walk GROUP BY 1, 2",
    )
)
def reference_walk(spark, sf_dir):
    """M2: references, two hops from every article."""
    parsed, kept = _cited(spark, sf_dir)
    return G.reachable(written(R.resolve(R.extract(parsed), kept), "references"), kept.where("kind = 'dieu'"), 2)


@query(
    S.lines_up(
        S.PARSED_SQL,
        S.STORED_SQL,
        S.CARDS_SQL,
        """q AS (SELECT embedding::DOUBLE[] AS e FROM embeddings WHERE vec_id = 0), v AS (SELECT vec_id, embedding::DOUBLE[] AS x FROM embeddings)""",
        select="""SELECT c.card_id, c.citation, round(list_dot_product(x, e) / sqrt(list_dot_product(x, x) * list_dot_product(e, e)), 6) AS score
        FROM cards c JOIN v ON v.vec_id = c.document_id, q WHERE c.topic = 'hóa đơn' AND c.penalty IS NOT NULL ORDER BY 3 DESC, 1 LIMIT 20""",
    )
)
def hybrid_retrieve(spark, sf_dir):
    """M1: cards of a topic with a penalty, by similarity of their documents' vectors."""
    vectors = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("document_id"), "embedding")
    first = vectors.where("document_id = 0").first()
    wanted = [float(x) for x in first["embedding"]] if first else []
    vectors = vectors if first else vectors.limit(0)
    have = C.extract(_clauses(spark, sf_dir)).join(vectors, "document_id")
    return H.retrieve(have, wanted, 20, topic="hóa đơn", penalty=True).select("card_id", "citation", F.round("score", 6).alias("score"))


_INSTRUMENT_NAME = f"^{X.WS}*({'|'.join(k.upper() for k in X.INSTRUMENTS)}){X.WS}+SỐ{X.WS}+([0-9]+(?:[/-][0-9A-ZĐƠƯ]+)*)"


def _instrument_sql(i: str, number: str, tail: str) -> str:
    """An instrument's citation by a number that stands for it."""
    kind = f"CASE {i} % 3 WHEN 0 THEN 'Thông tư' WHEN 1 THEN 'Nghị định' ELSE 'Luật' END"
    issuer = f"CASE {i} % 3 WHEN 0 THEN 'TT-BTC' WHEN 1 THEN 'NĐ-CP' ELSE 'QH' END"
    return f"concat({kind}, ' số ', {number}, '/', cast(2000 + {i} % 4 AS string), '/', {tail.format(issuer=issuer)})"


_TITLE = _instrument_sql("doc_id", "cast(doc_id % 50 + 1 AS string)", "{issuer}")
_CITED = _instrument_sql(
    "o_custkey",
    "concat(CASE WHEN o_orderkey % 7 = 3 THEN '0' ELSE '' END, cast(o_custkey % 50 + 1 + CASE WHEN o_orderkey % 11 = 0 THEN 50 ELSE 0 END AS string))",
    "CASE WHEN o_orderkey % 7 = 1 THEN left({issuer}, length({issuer}) - 1) ELSE {issuer} END",
)
_CITATION = f"CASE WHEN o_orderkey % 7 = 5 THEN 'Điều 5' WHEN o_orderkey % 7 = 2 THEN lower({_CITED}) ELSE {_CITED} END"
_CITED_ON = "CASE WHEN o_orderkey % 13 <> 0 THEN cast(o_orderdate AS date) END"
_SINCE = "doc_id * 37 % 3000"
_KEYS = "CASE WHEN {n} <> '' THEN array_to_string(list_transform(regexp_extract_all({n}, '[0-9]+'), lambda x: regexp_replace(x, '^0+([0-9])', '\\1')), '/') END AS numbers, CASE WHEN {n} <> '' THEN {k} || ' ' || regexp_replace({n}, '[0-9]+', '', 'g') END AS letters"


@query(
    f"""
    WITH titled AS (SELECT doc_id, upper({_TITLE}) AS t, {_SINCE} AS since FROM documents WHERE doc_id IS NOT NULL
    ), cited AS (SELECT o_orderkey, upper({_CITATION}) AS t, date_diff('day', DATE '1995-01-01', {_CITED_ON}) AS day FROM orders
    ), named AS (SELECT doc_id, since, {_KEYS.format(n="code", k="kind")} FROM (SELECT *, regexp_extract(t, '{_INSTRUMENT_NAME}', 1) AS kind, regexp_extract(t, '{_INSTRUMENT_NAME}', 2) AS code FROM titled)
    ), asked AS (SELECT o_orderkey, day, {_KEYS.format(n="code", k="kind")} FROM (SELECT *, regexp_extract(t, '{_INSTRUMENT_NAME}', 1) AS kind, regexp_extract(t, '{_INSTRUMENT_NAME}', 2) AS code FROM cited)
    ), chains AS (
      SELECT numbers, letters, since, max(doc_id) AS doc_id, row_number() OVER (PARTITION BY numbers, letters ORDER BY since) AS version FROM named GROUP BY numbers, letters, since
    ), known AS (SELECT DISTINCT numbers, letters FROM chains
    ), spelt AS (
      SELECT a.numbers, a.letters, CASE WHEN bool_or(k.letters = a.letters) THEN a.letters ELSE min(k.letters) END AS found, CASE WHEN bool_or(k.letters = a.letters) THEN 1 ELSE count(*) END AS likes, bool_or(k.letters = a.letters) AS exact
      FROM (SELECT DISTINCT numbers, letters FROM asked WHERE numbers IS NOT NULL) a JOIN known k ON k.numbers = a.numbers AND levenshtein(k.letters, a.letters) <= 1 GROUP BY a.numbers, a.letters
    ), held AS (
      SELECT a.*, s.found, s.likes, s.exact, c.doc_id, c.version
      FROM asked a LEFT JOIN spelt s ON s.numbers = a.numbers AND s.letters = a.letters ASOF LEFT JOIN chains c ON c.numbers = a.numbers AND c.letters = s.found AND a.day >= c.since
    ), told AS (
      SELECT *, CASE WHEN numbers IS NULL THEN '{N.NOT_NAMED}' WHEN found IS NULL THEN '{N.UNKNOWN}' WHEN likes > 1 THEN '{N.SEVERAL}' WHEN day IS NULL THEN '{N.NO_DATE}' WHEN doc_id IS NULL THEN '{N.NOT_YET}' END AS reason FROM held
    )
    SELECT o_orderkey, CASE WHEN reason IS NULL THEN doc_id END AS target_document_id, CASE WHEN reason IS NULL THEN version::INTEGER END AS version,
           CASE WHEN reason IS NULL THEN CASE WHEN exact THEN '{N.EXACT}' ELSE '{N.SPELT}' END END AS provenance, reason FROM told
    """.replace(" AS string)", " AS VARCHAR)")
)
def instrument_versions(spark, sf_dir):
    """M3: documents as versions of instruments, cited by orders on their dates, some misspelt, unknown, undated or no instrument."""
    docs = table(spark, sf_dir, "documents").where("doc_id IS NOT NULL").selectExpr("doc_id AS document_id", f"{_TITLE} AS title", f"date_add(DATE '1995-01-01', cast({_SINCE} AS int)) AS effective_from")
    refs = table(spark, sf_dir, "orders").selectExpr("o_orderkey", f"{_CITATION} AS target_citation", f"{_CITED_ON} AS cited_on")
    return N.resolve(refs, docs).select("o_orderkey", "target_document_id", "version", "provenance", "reason")


_HOPS = "hop AS (SELECT src_clause_id AS src, dst_clause_id AS dst FROM refs WHERE dst_clause_id IS NOT NULL UNION SELECT parent_id, clause_id FROM clauses WHERE parent_id IS NOT NULL)"


@query(
    S.lines_up(
        *_REFS,
        _HOPS,
        """walk AS (
          SELECT clause_id AS start_id, [clause_id] AS front, [clause_id] AS seen, 0 AS hops FROM clauses WHERE kind = 'dieu'
          UNION ALL
          SELECT start_id, fresh, list_concat(seen, fresh), hops + 1
          FROM (
            SELECT w.start_id, w.seen, w.hops, list_filter(list(DISTINCT h.dst), lambda x: NOT list_contains(w.seen, x)) AS fresh
            FROM (SELECT *, unnest(front) AS at FROM walk) w JOIN hop h ON h.src = w.at GROUP BY w.start_id, w.seen, w.hops
          ) WHERE len(fresh) > 0
        )""",
        select="SELECT start_id, unnest(front) AS node_id, hops, hops + 1 AS nodes FROM walk",
    )
)
def reference_closure(spark, sf_dir):
    """M2: all that every article leads to through its clauses and their references, however far, with the length of a shortest path."""
    parsed, kept = _cited(spark, sf_dir)
    found = G.closure(G.traversed(R.resolve(R.extract(parsed), kept), kept), kept.where("kind = 'dieu'"))
    return found.select("start_id", "node_id", "hops", F.size("path").alias("nodes"))


@query(
    S.lines_up(
        *_REFS,
        _HOPS,
        "far AS (SELECT src AS a, dst AS b FROM hop UNION SELECT f.a, h.dst FROM far f JOIN hop h ON h.src = f.b)",
        "both_ways AS (SELECT DISTINCT x.a, x.b FROM far x JOIN far y ON y.a = x.b AND y.b = x.a)",
        select="SELECT a AS node_id, min(b) AS component_id, count(*) AS size FROM both_ways GROUP BY a",
    )
)
def reference_cycles(spark, sf_dir):
    """M2: clauses that references lead back to, by strongly connected component."""
    parsed, kept = _cited(spark, sf_dir)
    return G.cycles(G.traversed(R.resolve(R.extract(parsed), kept), kept))


@query(
    S.lines_up(
        S.PARSED_SQL,
        S.STORED_SQL,
        S.CARDS_SQL,
        """v AS (SELECT vec_id, embedding::DOUBLE[] AS x, sqrt(list_dot_product(embedding::DOUBLE[], embedding::DOUBLE[])) AS len FROM embeddings
        ), found AS (
          SELECT c.card_id, c.document_id, c.bound_actor, c.topic, c.penalty IS NOT NULL AS penalty, replace(c.citation, 'Điều ', '') AS article, x, len,
                 EXISTS (SELECT 1 FROM clauses k WHERE k.document_id = c.document_id AND k.kind = 'khoan' AND k.number = '1' AND 'Điều ' || k.dieu = c.citation) AS first_khoan
          FROM cards c JOIN v ON v.vec_id = c.document_id
        ), asked AS (
          SELECT vec_id AS query_id, x AS q, len AS qlen, CASE WHEN vec_id % 3 = 1 THEN 'hóa đơn' WHEN vec_id % 3 = 2 THEN 'xử phạt' END AS topic, CASE WHEN vec_id % 4 = 3 THEN vec_id % 8 = 3 END AS penalty,
                 CASE WHEN vec_id % 5 = 4 THEN '2' END AS article, CASE WHEN vec_id % 7 = 6 THEN '1' END AS khoan
          FROM v WHERE vec_id % 10 < 5
        )""",
        select="""SELECT query_id, rank, card_id, round(score, 6) AS score FROM (
          SELECT query_id, card_id, list_dot_product(x, q) / (len * qlen) AS score, row_number() OVER (PARTITION BY query_id ORDER BY list_dot_product(x, q) / (len * qlen) DESC, card_id)::INTEGER AS rank
          FROM asked a JOIN found f ON (a.topic IS NULL OR a.topic = f.topic) AND (a.penalty IS NULL OR a.penalty = f.penalty) AND (a.article IS NULL OR a.article = f.article) AND (a.khoan IS NULL OR f.first_khoan)
        ) WHERE rank <= 10""",
    )
)
def retrieve_many(spark, sf_dir):
    """M1: half the vectors as queries with filters by topic, penalty, article and Khoản, against a kept index of all cards."""
    vectors = table(spark, sf_dir, "embeddings")
    kept = written(_clauses(spark, sf_dir), "clauses")
    have = C.extract(kept).join(vectors.select(F.col("vec_id").alias("document_id"), "embedding"), "document_id")
    index = I.Index.build(I.described(have, kept), written_to(spark))
    n = F.col("vec_id")
    asked = vectors.where(n % 10 < 5).select(
        n.alias("query_id"),
        "embedding",
        F.when(n % 3 == 1, "hóa đơn").when(n % 3 == 2, "xử phạt").alias("topic"),
        F.when(n % 4 == 3, n % 8 == 3).alias("penalty"),
        F.when(n % 5 == 4, "2").alias("article"),
        F.when(n % 7 == 6, "1").alias("khoan"),
    )
    return index.search(asked, 10).select("query_id", "rank", "card_id", F.round("score", 6).alias("score"))


@query(S.lines_up(S.PARSED_SQL, S.STORED_SQL, S.ARTICLES_SQL, select="SELECT DISTINCT document_id, num::BIGINT AS num FROM articles a WHERE num < (SELECT min(num) FROM articles b WHERE b.document_id = a.document_id)"))
def numbering_extras(spark, sf_dir):
    """Numbers outside their own range, of which there are none."""
    return Q.extra_numbers(_clauses(spark, sf_dir))


@query(
    S.lines_up(
        S.PARSED_SQL,
        S.STORED_SQL,
        S.CARDS_SQL,
        select="""SELECT k.card_id, (k.document_id % 2 + 1)::INTEGER AS generation, k.citation, k.bound_actor, k.penalty, CASE WHEN k.document_id % 2 = 1 THEN k.topic END AS topic, CASE WHEN k.document_id % 2 = 1 THEN c.page_start END AS page_start
        FROM cards k JOIN clauses c ON c.clause_id = k.clause_id WHERE k.document_id % 2 = 0 OR k.topic IS NOT NULL""",
    )
)
def card_generations(spark, sf_dir):
    """M5: cards of two generations as variants in one table, read by paths that the older one lacks: all of the older, and the newer that have a topic."""
    kept = written(_clauses(spark, sf_dir), "clauses")
    made = C.extract(kept).where("error IS NULL").join(kept.select("clause_id", "page_start", "page_end"), "clause_id")
    path = written_to(spark)
    older, newer = (variants.written_as(made.where(F.col("document_id") % 2 == g - 1), g) for g in (1, 2))
    variants.write_cards(older.unionByName(newer), path)
    rows = variants.with_fields(variants.read_cards(spark, path), "citation", "bound_actor", "penalty", "topic_tags", "page_start")
    topic = F.get("topic_tags", F.lit(0))
    return rows.where((F.col("generation") == 1) | topic.isNotNull()).select("card_id", "generation", "citation", "bound_actor", "penalty", topic.alias("topic"), "page_start")


@query(
    S.lines_up(
        patches.PATCHES_SQL,
        select="SELECT document_id, page_ordinal, md5(new) AS text_md5, (p1::INTEGER + p2::INTEGER + p3::INTEGER + p4::INTEGER) AS patches, spans FROM fixed JOIN spans USING (document_id, page_ordinal)",
    )
)
def span_corrections(spark, sf_dir):
    """M4: stretches of pages replaced, the later of two that overlap, and the spans of their lines moved along."""
    return patches.patches_query(lines(spark, sf_dir))


# ---- lookups, stages and artifacts


@query("SELECT d.doc_id, d.source FROM documents d WHERE d.doc_id IN (SELECT doc_id FROM labels WHERE quality = 0)")
def documents_by_id(spark, sf_dir):
    """B1: the documents of low quality, looked up by their ids."""
    wanted = table(spark, sf_dir, "labels").where("quality = 0").select("doc_id")
    return K.found(table(spark, sf_dir, "documents").select("doc_id", "source"), wanted, ["doc_id"])


@query(S.lines_up(select="SELECT document_id, page AS page_ordinal, row_number() OVER (PARTITION BY document_id ORDER BY page)::INTEGER AS place FROM (SELECT DISTINCT document_id, page FROM lines WHERE document_id IN (SELECT doc_id FROM labels))"))
def pages_of_document(spark, sf_dir):
    """The pages of the labelled documents, in order."""
    pages = lines(spark, sf_dir).select("document_id", F.col("page").alias("page_ordinal")).distinct()
    wanted = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("document_id"))
    order = Window.partitionBy("document_id").orderBy("page_ordinal")
    return K.found(pages, wanted, ["document_id"]).withColumn("place", F.row_number().over(order))


@query("SELECT user_id, event_type, count(*) AS n FROM events WHERE (user_id, event_type) IN (SELECT (user_id, event_type) FROM events WHERE event_id % 97 = 0) GROUP BY ALL")
def checkpoints_by_key(spark, sf_dir):
    """Marks by their whole key (user and type), those of every 97th event."""
    rows = table(spark, sf_dir, "events")
    key = ["user_id", "event_type"]
    return K.found(rows.select(*key), rows.where("event_id % 97 = 0"), key).groupBy(*key).agg(F.count("*").alias("n"))


@query(
    S.lines_up(
        S.PARSED_SQL, S.STORED_SQL, select="SELECT clause_id, document_id, citation FROM clauses WHERE citation = 'Điều ' || (document_id % 7) OR clause_id IN (SELECT document_id * 16777216 + 2 FROM clauses)"
    )
)
def clause_lookup(spark, sf_dir):
    """By citation, and by id."""
    _, kept = _parsed(spark, sf_dir)
    rows, ids = kept.select("clause_id", "document_id", "citation"), kept.select("document_id").distinct()
    cited = ids.select("document_id", F.concat(F.lit("Điều "), (F.col("document_id") % 7).cast("string")).alias("citation"))
    second = ids.select((F.shiftleft("document_id", 24) + 2).alias("clause_id"))
    return K.found(rows, cited, ["document_id", "citation"]).unionByName(K.found(rows, second, ["clause_id"])).distinct()


@query(S.lines_up(S.PARSED_SQL, select="SELECT document_id, count(DISTINCT citation) AS citations, md5(string_agg(citation || ':' || ord || ':' || kind, ',' ORDER BY citation)) AS map_md5 FROM (SELECT DISTINCT ON (document_id, citation) * FROM parsed ORDER BY document_id, citation, ord DESC) GROUP BY document_id"))
def citation_map(spark, sf_dir):
    """Citations and their last clauses, as a map."""
    rows = K.citation_map(K.parse_lines(lines(spark, sf_dir)))
    said = F.transform(F.array_sort(F.map_entries("clauses")), lambda e: F.concat_ws(":", e["key"], e["value"]["ord"].cast("string"), e["value"]["kind"]))
    return rows.select("document_id", F.size("clauses").cast("long").alias("citations"), F.md5(F.array_join(said, ",")).alias("map_md5"))


_EMBEDDED_SQL = """embedded AS (
  SELECT c.*, v.embedding, coalesce(l.quality = 1, false) AND coalesce(len(v.embedding) = 64, false) AS skip
  FROM cards c LEFT JOIN embeddings v ON v.vec_id = c.document_id LEFT JOIN labels l ON l.doc_id = c.document_id
)"""


def _embedded(spark, sf_dir, kept):
    vectors = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("document_id"), "embedding")
    return C.extract(kept).join(vectors, "document_id", "left")


def _marks(spark, sf_dir, kept, stage):
    labels = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("document_id"), F.when(F.col("quality") == 1, "done").otherwise("failed").alias("status"))
    return kept.join(labels, "document_id").select("document_id", F.lit(stage).alias("stage"), F.col("clause_id").alias("unit_id"), "status")


@query(S.lines_up(S.PARSED_SQL, S.STORED_SQL, S.CARDS_SQL, _EMBEDDED_SQL, select="SELECT clause_id, 1 AS place, card_id, embedding IS NOT NULL AS has_embedding FROM embedded"))
def cards_of_clause(spark, sf_dir):
    """Each article's cards, and whether they have a vector."""
    _, kept = _parsed(spark, sf_dir)
    return C.of_clause(_embedded(spark, sf_dir, kept), kept).drop("statement")


@query(S.lines_up(S.PARSED_SQL, S.STORED_SQL, S.CARDS_SQL, _EMBEDDED_SQL, select="SELECT card_id, skip FROM embedded"))
def embed_pending(spark, sf_dir):
    """Cards that are done and have a vector of the dimension are left out."""
    _, kept = _parsed(spark, sf_dir)
    return stages.to_embed(_embedded(spark, sf_dir, kept), _marks(spark, sf_dir, kept, "embed"), 64).select("card_id", "skip")


@query(
    S.lines_up(
        S.PARSED_SQL,
        S.STORED_SQL,
        S.CARDS_SQL,
        _EMBEDDED_SQL,
        select="""SELECT cards_scanned, embedded, skipped, 64 AS dim, mismatched, failed, mismatched = 0 AND failed = 0 AS ok FROM (
          SELECT count(*) AS cards_scanned, count(*) FILTER (WHERE NOT skip AND document_id % 5 > 1) AS embedded, count(*) FILTER (WHERE skip) AS skipped,
                 count(*) FILTER (WHERE NOT skip AND document_id % 5 = 1) AS mismatched, count(*) FILTER (WHERE NOT skip AND document_id % 5 = 0) AS failed FROM embedded)""",
    )
)
def embed_summary(spark, sf_dir):
    """An encoder that fails for a fifth of the documents, and has another dimension for a fifth."""
    _, kept = _parsed(spark, sf_dir)
    cards = stages.to_embed(_embedded(spark, sf_dir, kept), _marks(spark, sf_dir, kept, "embed"), 64)
    made = F.when(F.col("document_id") % 5 == 1, F.array_repeat(F.lit(1.0), 32)).when(F.col("document_id") % 5 > 1, F.array_repeat(F.lit(1.0), 64))
    return stages.embed_summary(cards, cards.where("NOT skip").select("card_id", made.alias("embedding")), 64)


@query(
    S.lines_up(
        S.PARSED_SQL,
        S.STORED_SQL,
        S.CARDS_SQL,
        select="""SELECT clauses_scanned, cards_inserted, skipped, failed, failed = 0 AS ok FROM (
          SELECT count(*) AS clauses_scanned, count(*) FILTER (WHERE NOT done AND card_id IS NOT NULL AND document_id % 7 > 0) AS cards_inserted, count(*) FILTER (WHERE done) AS skipped,
                 count(*) FILTER (WHERE NOT done AND card_id IS NOT NULL AND document_id % 7 = 0) AS failed
          FROM (SELECT k.document_id, c.card_id, coalesce(l.quality = 1, false) AS done FROM clauses k LEFT JOIN cards c USING (clause_id) LEFT JOIN labels l ON l.doc_id = k.document_id WHERE k.kind = 'dieu'))""",
    )
)
def cards_summary(spark, sf_dir):
    """Articles whose marks are done are left out; those of every seventh document fail validation."""
    _, kept = _parsed(spark, sf_dir)
    units = kept.where("kind = 'dieu'")
    done = _marks(spark, sf_dir, units, "cards").where("status = 'done'").select(F.col("unit_id").alias("clause_id"))
    todo = units.join(done, "clause_id", "left_anti")
    made = C.extract(todo).drop("error").withColumn("statement", F.when(F.col("document_id") % 7 == 0, " ").otherwise(F.col("statement")))
    return C.stage_summary(units, done, C.validated(made))


@query(
    """SELECT document_id, stage, count(*) AS n FROM (SELECT doc_id AS document_id, unnest(['ocr', 'cards', 'embed', 'cards']) AS stage FROM documents WHERE doc_id IS NOT NULL) m
       WHERE stage = 'ocr' OR document_id NOT IN (SELECT doc_id FROM labels WHERE toxic = 1) GROUP BY ALL"""
)
def cards_rebuild(spark, sf_dir):
    """U8: the checkpoints that a rebuild of some documents' cards leaves."""
    marks = table(spark, sf_dir, "documents").where("doc_id IS NOT NULL").select(F.col("doc_id").alias("document_id"), F.explode(F.array(*map(F.lit, ("ocr", "cards", "embed", "cards")))).alias("stage"))
    gone = table(spark, sf_dir, "labels").where("toxic = 1").select(F.col("doc_id").alias("document_id"))
    return stages.rebuilt_marks(marks, gone).groupBy("document_id", "stage").agg(F.count("*").alias("n"))


@query(
    """SELECT d.doc_id AS document_id, (n_chars % 9 + 1)::INTEGER AS page_ordinal, '[stub OCR] page=' || (n_chars % 9 + 1) || ' image=page' || lpad((n_chars % 9 + 1)::VARCHAR, 4, '0') || '.png' AS raw_text,
       1 AS blocks, 'done' AS status FROM documents d WHERE n_chars IS NOT NULL AND d.doc_id NOT IN (SELECT doc_id FROM labels WHERE quality = 1)"""
)
def transcribe_pages(spark, sf_dir):
    """The stub backend, called page by page for pages that aren't done."""
    page = (F.col("n_chars") % 9 + 1).cast("int")
    docs = table(spark, sf_dir, "documents").where("n_chars IS NOT NULL")
    pages = docs.select(F.col("doc_id").alias("document_id"), page.alias("page_ordinal"), X.page_image_path(F.lit("out"), F.col("doc_id"), page).alias("image_path"))
    good = table(spark, sf_dir, "labels").where("quality = 1").select(F.col("doc_id").alias("document_id"))
    marks = pages.join(good, "document_id").select("document_id", F.lit("ocr").alias("stage"), F.col("page_ordinal").alias("unit_id"), F.lit("done").alias("status"))
    return ocr.transcribe(pages, ocr.StubBackend(), marks).select("document_id", "page_ordinal", "raw_text", F.size("blocks").alias("blocks"), "status")


@query(
    S.lines_up(
        *_REFS,
        select="""SELECT document_id, src_clause_id, target_citation, CASE WHEN target_citation = 'Thông tư số 39/2014/TT-BTC' THEN (SELECT min(doc_id) FROM documents WHERE doc_id % 10 = 3) END AS target_document_id
        FROM refs WHERE kind = 'external'""",
    )
)
def external_documents(spark, sf_dir):
    """M3: external references and the first document that has their target as its title."""
    titled = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("document_id"), F.when(F.col("doc_id") % 10 == 3, "Thông tư số 39/2014/TT-BTC").alias("title"))
    refs = _references(spark, sf_dir).where("kind = 'external'")
    return G.external_documents(refs, titled).select("document_id", "src_clause_id", "target_citation", "target_document_id")


@query("SELECT d.doc_id AS document_id, 1 AS page_ordinal, md5(CASE WHEN l.doc_id IS NOT NULL THEN 'corrected ' || d.doc_id ELSE d.text END) AS text_md5 FROM documents d LEFT JOIN (SELECT DISTINCT doc_id FROM labels WHERE toxic = 1) l ON l.doc_id = d.doc_id")
def errata(spark, sf_dir):
    """M4: pages with corrections in place of their text."""
    pages = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("document_id"), F.lit(1).alias("page_ordinal"), F.col("text").alias("raw_text"))
    fixes = table(spark, sf_dir, "labels").where("toxic = 1").select(F.col("doc_id").alias("document_id"), F.lit(1).alias("page_ordinal"), F.concat(F.lit("corrected "), F.col("doc_id").cast("string")).alias("raw_text")).distinct()
    return G.corrected(pages, fixes).select("document_id", "page_ordinal", F.md5("raw_text").alias("text_md5"))


@query(
    S.lines_up(
        S.PARSED_SQL,
        S.STORED_SQL,
        select="""SELECT p.document_id, p.page_count, coalesce(n, 0) AS clauses, coalesce(ids, 0) AS ids, coalesce(said, md5('')) AS said_md5
        FROM (SELECT document_id, max(page)::INTEGER AS page_count FROM lines GROUP BY 1) p LEFT JOIN (
          SELECT document_id, count(*) AS n, sum(clause_id)::BIGINT AS ids, md5(string_agg(concat_ws(':', ord, kind, citation, page_start, page_end, above_numbers, body), chr(10) ORDER BY ord)) AS said
          FROM (SELECT p.*, c.clause_id, CASE WHEN p.kind = 'dieu' OR p.dieu IS NULL THEN '-' WHEN p.kind = 'diem' AND p.khoan IS NOT NULL THEN p.dieu || '/' || p.khoan ELSE p.dieu END AS above_numbers
                FROM parsed p JOIN clauses c USING (document_id, citation)) GROUP BY 1
        ) c USING (document_id)""",
    )
)
def clauses_json(spark, sf_dir):
    """Each document's clause graph, written as JSON and read again."""
    parsed, kept = _parsed(spark, sf_dir)
    path = written_to(spark)
    artifacts.write(artifacts.clause_graphs(lines(spark, sf_dir), parsed, kept), path, "clauses.json")
    back = artifacts.read(spark, path, "clauses.json", artifacts.GRAPH)
    one = lambda c: F.concat_ws(":", c["ord"].cast("string"), c["kind"], c["citation"], c["page_start"].cast("string"), c["page_end"].cast("string"), F.coalesce(F.array_join(c["parent_number"], "/"), F.lit("-")), c["body"])
    return back.select(
        "document_id",
        "page_count",
        F.size("clauses").cast("long").alias("clauses"),
        F.aggregate("clauses", F.lit(0).cast("long"), lambda a, c: a + c["id"]).alias("ids"),
        F.md5(F.array_join(F.transform("clauses", one), "\n")).alias("said_md5"),
    )


@query(
    S.lines_up(
        S.PARSED_SQL,
        S.STORED_SQL,
        S.CARDS_SQL,
        _EMBEDDED_SQL,
        select="""SELECT d.doc_id AS document_id, coalesce(n, 0) AS card_count, coalesce(said, md5('')) AS said_md5 FROM documents d LEFT JOIN (
          SELECT document_id, count(*) AS n, md5(string_agg(concat_ws(':', card_id, clause_id, statement, (embedding IS NOT NULL)::VARCHAR), chr(10) ORDER BY card_id)) AS said FROM embedded GROUP BY 1
        ) c ON c.document_id = d.doc_id WHERE d.doc_id IS NOT NULL""",
    )
)
def cards_json(spark, sf_dir):
    """Each document's cards, written as JSON and read again."""
    _, kept = _parsed(spark, sf_dir)
    path = written_to(spark)
    documents = table(spark, sf_dir, "documents").where("doc_id IS NOT NULL").select(F.col("doc_id").alias("document_id"))
    artifacts.write(artifacts.card_files(documents, _embedded(spark, sf_dir, kept)), path, "cards.json")
    back = artifacts.read(spark, path, "cards.json", artifacts.CARDS)
    one = lambda c: F.concat_ws(":", c["id"].cast("string"), c["clause_id"].cast("string"), c["statement"], c["has_embedding"].cast("string"))
    return back.select("document_id", "card_count", F.md5(F.array_join(F.transform("cards", one), "\n")).alias("said_md5"))


_EARLY_SQL = S.PARSED_SQL
for _name in ("heads", "numbered", "grouped", "parents", "parsed"):
    _EARLY_SQL = re.sub(rf"\b{_name}\b", f"early_{_name}", _EARLY_SQL)
_EARLY_SQL = re.sub(r"\bFROM lines\b", "FROM early_lines", _EARLY_SQL)


@query(
    S.lines_up(
        S.PARSED_SQL,
        "early_lines AS (SELECT * FROM lines WHERE page % 2 = 0)",
        _EARLY_SQL,
        """every AS (
          SELECT document_id, citation, kind, ord, body, above FROM (SELECT DISTINCT ON (document_id, citation) * FROM parsed ORDER BY document_id, citation, ord DESC)
          UNION ALL SELECT document_id, citation, kind, ord, body, above FROM (SELECT DISTINCT ON (document_id, citation) * FROM early_parsed ORDER BY document_id, citation, ord DESC) e
          WHERE NOT EXISTS (SELECT 1 FROM parsed p WHERE p.document_id = e.document_id AND p.citation = e.citation)
        )""",
        select="SELECT document_id, citation, kind, ord, md5(body) AS body_md5, above AS parent_citation, 1::BIGINT AS same_id FROM every",
    )
)
def reparse_clauses(spark, sf_dir):
    """Every second page first, then all: what the table holds, each clause's parent by its id, and how many clauses have its id."""
    view = lines(spark, sf_dir)
    parse = lambda rows: written(K.stored(K.parse_lines(rows)).drop("dieu"), "parse")
    early = parse(view.where("page % 2 = 0"))
    first = written(store.merged_clauses(early.limit(0), early), "first")
    kept = written(store.merged_clauses(first, parse(view)), "then")
    above = kept.select(F.col("clause_id").alias("above"), F.col("citation").alias("parent_citation"))
    same = F.count("*").over(Window.partitionBy("clause_id"))
    rows = kept.withColumn("same_id", same).join(above, F.col("parent_id") == F.col("above"), "left")
    return rows.select("document_id", "citation", "kind", "ord", F.md5("body").alias("body_md5"), "parent_citation", "same_id")


@query(S.lines_up(S.PARSED_SQL, select="SELECT document_id, ord, kind, number, citation, page_start, page_end, md5(body) AS body_md5 FROM parsed"))
def stateful_ingest(spark, sf_dir):
    """Pages in two deliveries, in no order and some first with other text, taken by two runs of one stream; the clauses that hold then are those of whole documents."""
    ordered = F.array_sort(F.collect_list(F.struct("line_no", "line")))
    pages = lines(spark, sf_dir).groupBy("document_id", F.col("page").alias("page_ordinal")).agg(F.array_join(F.transform(ordered, lambda x: x["line"]), "\n").alias("raw_text"))
    pages = pages.withColumn("second", F.pmod(F.xxhash64("document_id", "page_ordinal"), F.lit(3)) == 0)
    early = pages.where("second AND page_ordinal % 2 = 0").withColumn("raw_text", F.lit("Điều 999. x"))
    path, out = written_to(spark), written_to(spark)
    for delivery in (pages.where("NOT second").unionByName(early), pages.where("second")):
        delivery.select("document_id", "page_ordinal", "raw_text").write.mode("append").option("compression", "gzip").json(path)
        articles.ingest(spark, path, out)
    return articles.current(spark, out).select("document_id", "ord", "kind", "number", "citation", "page_start", "page_end", F.md5("body").alias("body_md5"))


@query(S.lines_up(select="SELECT document_id, page AS page_ordinal, md5(string_agg(line, chr(10) ORDER BY line_no)) AS text_md5, 1::INTEGER AS blocks FROM lines GROUP BY ALL"))
def page_files(spark, sf_dir):
    """Every page as a file of its own, read back with document and ordinal from the files' places."""
    ordered = F.array_sort(F.collect_list(F.struct("line_no", "line")))
    pages = lines(spark, sf_dir).groupBy("document_id", F.col("page").alias("page_ordinal")).agg(F.array_join(F.transform(ordered, lambda x: x["line"]), "\n").alias("raw_text"))
    block = F.struct(F.lit("text").alias("kind"), F.array(F.lit(0.0)).alias("bbox"), F.col("raw_text").alias("text"))
    path = written_to(spark)
    ocr.write_page_files(pages.withColumn("blocks", F.array(block)), path)
    return ocr.read_page_files(spark, path).select("document_id", "page_ordinal", F.md5("raw_text").alias("text_md5"), F.size("blocks").alias("blocks"))
