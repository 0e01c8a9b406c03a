"""Cards of two generations in one table."""

from pyspark.sql import functions as F

from clausemill.operators import variants
from clausemill.operators import vectors as V

CARDS = "card_id long, document_id long, citation string, statement string, bound_actor string, penalty string, topic_tags array<string>, required_facts array<string>, page_start int, page_end int"


def test_two_generations(spark, tmp_path):
    rows = [(1, 1, "Điều 1", "một", "tổ chức", "5 triệu", ["phạt"], ["f"], 2, 3), (2, 1, "Điều 2", 'hai "x"', None, None, [], None, 4, 4)]
    cards = spark.createDataFrame(rows, CARDS)
    path = str(tmp_path / "cards")
    variants.write_cards(variants.written_as(cards, 1), path)
    before = variants.with_fields(variants.read_cards(spark, path)).count()
    odd = spark.createDataFrame([(3, 2, "{bad", 2), (4, 2, '{"citation": ["not", "text"], "extra": {"a": 1.5}, "topics": "one"}', 2), (5, 2, None, 2)], "card_id long, document_id long, json string, generation int")
    variants.write_cards(variants.written_as(cards, 2).unionByName(odd), path)
    variants.write_cards(variants.written_as(cards, 2).unionByName(odd), path)  # again: the same
    got = {(r["generation"], r["card_id"]): r for r in variants.with_fields(variants.read_cards(spark, path)).collect()}
    assert before == 2 and len(got) == 7
    old, new = got[1, 1], got[2, 1]
    assert (old["statement"], old["bound_actor"], old["topic_tags"], old["page_end"]) == ("một", "tổ chức", None, None)
    assert (new["statement"], new["topic_tags"], new["required_facts"], new["page_start"], new["page_end"]) == ("một", ["phạt"], ["f"], 2, 3)
    assert got[2, 2]["statement"] == 'hai "x"' and got[2, 2]["topic_tags"] == [] and got[2, 2]["penalty"] is None
    assert got[2, 3]["citation"] is None and got[2, 4]["topic_tags"] is None and got[2, 5]["statement"] is None
    raw = {r["card_id"]: r["raw"] for r in variants.read_cards(spark, path).where("generation = 2").collect()}
    assert raw == {1: None, 2: None, 3: "{bad", 4: None, 5: None}
    found = variants.read_cards(spark, path).where(F.get(variants.field("topic_tags"), F.lit(0)) == "phạt")
    assert [(r["card_id"], r["generation"]) for r in found.collect()] == [(1, 2)]
    told = {r["generation"]: (r["cards"], r["schema"]) for r in variants.schemas(variants.read_cards(spark, path)).collect()}
    assert told[1][0] == 2 and "topics" not in told[1][1] and told[2][0] == 3 and "extra" in told[2][1]


def test_encoder_by_environment(monkeypatch):
    monkeypatch.delenv("CLAUSEMILL_EMBEDDING_MODEL", raising=False)
    assert isinstance(V.default_encoder(32), V.HashBag) and V.default_encoder(32).dim == 32
    monkeypatch.setenv("CLAUSEMILL_EMBEDDING_MODEL", "some/model")
    assert V.default_encoder().name == "some/model" and V.default_encoder(model="other").name == "other"
    monkeypatch.setenv("CLAUSEMILL_EMBEDDING_MODEL", "")
    assert isinstance(V.default_encoder(), V.HashBag)
