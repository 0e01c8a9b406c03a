"""Tables that grow with the documents aren't broadcast, however small their files are."""

from clausemill.plans import catalogue
from jobs import rule_catalogue


def _broadcasts(df) -> int:
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().count("BroadcastHashJoin")


def test_clauses_are_not_broadcast_to_references(spark, sf_dir):
    assert _broadcasts(catalogue.refs_in_degree(spark, sf_dir)) == 0


def test_counts_by_document_are_not_broadcast(spark, sf_dir):
    assert _broadcasts(catalogue.structure_summary(spark, sf_dir)) == 0


def test_the_catalogue_broadcasts_nothing(spark):
    kept = spark.createDataFrame([(1, 1, "1", 1, 1), (2, 1, "2", 1, 1)], "clause_id long, document_id long, dieu string, page_start int, page_end int")
    refs = spark.createDataFrame([(1, 1, 2), (1, 2, None)], "document_id long, src_clause_id long, dst_clause_id long")
    cards = spark.createDataFrame(
        [(k, k, 1, f"Điều {k}", "s", "a", None, ["t"], None) for k in (1, 2)],
        "card_id long, clause_id long, document_id long, citation string, statement string, bound_actor string, penalty string, topic_tags array<string>, error string",
    )
    made = rule_catalogue.catalogue(kept, cards, refs, "none")
    assert _broadcasts(made) == 0
    assert sorted((r["card_id"], r["refs_resolved"], r["refs_dangling"], r["cited_by"]) for r in made.collect()) == [(1, 1, 0, 0), (2, 0, 1, 1)]
