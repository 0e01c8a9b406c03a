"""Table schemas; read with these, never inferred."""

from pyspark.sql import types as T


_KINDS = {
    "long": T.LongType(),
    "int": T.IntegerType(),
    "string": T.StringType(),
    "time": T.TimestampType(),
    "strings": T.ArrayType(T.StringType()),
    "floats": T.ArrayType(T.FloatType()),
    "doubles": T.ArrayType(T.DoubleType()),
}


def _of(**fields) -> T.StructType:
    """Built without a session, as workers import this too."""
    return T.StructType([T.StructField(name, _KINDS.get(kind, kind) if isinstance(kind, str) else kind) for name, kind in fields.items()])


DOCUMENTS = _of(document_id="long", source_path="string", title="string", ingested_at="time")
PAGES = _of(document_id="long", page_ordinal="int", image_path="string", width="int", height="int", dpi="int")
BLOCK = _of(kind="string", bbox="doubles", text="string")
OCR_PAGES = _of(document_id="long", page_ordinal="int", image_path="string", blocks=T.ArrayType(BLOCK), raw_text="string")
CHECKPOINTS = _of(document_id="long", stage="string", unit_id="long", status="string", artifact_path="string", updated_at="time")
CLAUSES = _of(
    clause_id="long", document_id="long", parent_id="long", kind="string", number="string", citation="string", page_start="int", page_end="int", body="string", ord="int"
)
REFERENCES = _of(reference_id="long", src_clause_id="long", dst_clause_id="long", kind="string", raw_text="string", target_citation="string", target_document_id="long")
CARDS = _of(
    card_id="long", clause_id="long", document_id="long", citation="string", statement="string", bound_actor="string",
    topic_tags="strings", required_facts="strings", penalty="string", body_md5="string", embedding="floats",
)
TABLES = {"documents": DOCUMENTS, "pages": PAGES, "ocr_pages": OCR_PAGES, "checkpoints": CHECKPOINTS, "clauses": CLAUSES, "clause_references": REFERENCES, "rule_cards": CARDS}

CLAUSE_KINDS = ("dieu", "khoan", "diem")
REFERENCE_KINDS = ("internal", "external")
STATUSES = ("done", "failed")
STAGES = ("pages", "ocr", "structure", "cards", "embed")
DEFAULT_DPI, DEFAULT_DIM, MODEL_DIM, MOST_STATEMENT = 300, 128, 1024, 600
