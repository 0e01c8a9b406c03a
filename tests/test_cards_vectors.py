import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from clausemill.functions import text as X
from clausemill.operators import cards as C
from clausemill.operators import graph as G
from clausemill.operators import vectors as V


def card(spark, body, kind="dieu"):
    df = spark.createDataFrame([(7, 1, kind, "Điều 4", body)], "clause_id long, document_id long, kind string, citation string, body string")
    got = C.extract(df).collect()
    return got[0] if got else None


def test_card_fields(spark):
    r = card(spark, "Điều 4. Doanh nghiệp lập hóa đơn sai bị phạt tiền từ 4 triệu. Phần sau")
    assert r["statement"] == "Điều 4: Doanh nghiệp lập hóa đơn sai bị phạt tiền từ 4 triệu"
    assert (r["bound_actor"], r["topic_tags"], r["required_facts"]) == ("doanh nghiệp", ["hóa đơn"], ["Áp dụng theo Điều 4"])
    assert r["penalty"] == "phạt tiền từ 4 triệu" and r["error"] is None


def test_defaults_and_priorities(spark):
    r = card(spark, "Quy định chung; phần hai")
    assert (r["statement"], r["bound_actor"], r["topic_tags"], r["penalty"]) == ("Điều 4: Quy định chung", "người nộp thuế", [], None)
    assert card(spark, "Cá nhân kinh doanh và tổ chức bị phạt")["bound_actor"] == "cá nhân kinh doanh"
    assert card(spark, "bị phạt")["topic_tags"] == ["xử phạt"]


def test_long_gloss_is_cut_and_no_card_without_prose(spark):
    assert len(card(spark, "x" * 900)["statement"]) == len("Điều 4: ") + 280
    assert card(spark, "Điều 4. ") is None and card(spark, "x", "khoan") is None


@pytest.mark.parametrize(
    "values,error",
    [
        (("s", "a", ["t"], ["f"], None), None),
        ((" ", "a", ["t"], ["f"], None), "statement is blank"),
        (("s" * 601, "a", ["t"], ["f"], None), "statement is too long"),
        (("s", " ", ["t"], ["f"], None), "bound_actor is blank"),
        (("s", "a", [" "], ["f"], None), "topic_tags holds a blank"),
        (("s", "a", ["t"], None, None), "required_facts holds a blank"),
        (("s", "a", ["t"], ["f"], " "), "penalty is blank"),
    ],
)
def test_validation(spark, values, error):
    df = spark.createDataFrame([values], "statement string, bound_actor string, topic_tags array<string>, required_facts array<string>, penalty string")
    assert C.validated(df).first()["error"] == error


def test_tokens(spark):
    df = spark.createDataFrame([("Thuế GTGT, hóa_đơn số 12!",)], "t string")
    assert df.select(X.tokens(F.col("t"))).first()[0] == ["thuế", "gtgt", "hóa_đơn", "số", "12"]


def test_hash_bag(spark):
    bag = V.HashBag(64)
    want = np.zeros(64)
    for t in ("một", "hai", "hai"):
        want[int.from_bytes(hashlib.blake2b(t.encode(), digest_size=8).digest(), "big") % 64] += 1
    assert np.allclose(bag.encode("Một hai HAI"), want / np.linalg.norm(want))
    assert bag.encode_batch([]).shape == (0, 64) and not bag.encode("").any()
    with pytest.raises(ValueError):
        V.HashBag(0)
    a, b, c = (bag.encode(t) for t in ("nộp thuế giá trị gia tăng", "nộp thuế giá trị gia tăng sớm", "con mèo ngủ"))
    assert a @ b > a @ c


def test_normalize():
    assert np.allclose(V.normalize(np.array([3.0, 4.0])), [0.6, 0.8]) and not V.normalize(np.zeros(2)).any()
    with pytest.raises(ValueError):
        V.normalize(np.zeros((1, 1, 1)))


def test_bytes_round_trip(spark):
    df = spark.createDataFrame([(1, [1.5, -2.0]), (2, None)], "id long, embedding array<float>")
    back = V.from_bytes(V.to_bytes(df, 2).drop("embedding")).orderBy("id").collect()
    assert back[0]["embedding"] == [1.5, -2.0] and back[1]["embedding"] is None


def test_audit(spark):
    df = spark.createDataFrame([(1, [0.0] * 64), (2, [0.0] * 64), (3, None)], "id long, embedding array<float>")
    r = V.dimension_audit(df, "id", 128).first()
    assert r["checked"] == 2 and r["mismatched"] == 2 and not r["ok"]
    assert {(x["id"], x["actual"], x["expected"]) for x in V.dimension_mismatches(df, "id", 128).collect()} == {(1, 64, 128), (2, 64, 128)}


def test_walks(spark):
    refs = spark.createDataFrame([(1, 2), (2, 3), (3, 1), (3, None)], "src_clause_id long, dst_clause_id long")
    starts = spark.createDataFrame([(1,)], "clause_id long")
    assert {(r["clause_id"], r["hops"]) for r in G.reachable(refs, starts, 5).collect()} == {(1, 0), (2, 1), (3, 2)}


def test_vectors_are_made_and_packed_a_few_at_a_time(spark, monkeypatch):
    """However many texts come at once, so many vectors are held as ``ENCODED`` says; packing keeps nulls and tells of a wrong length."""
    monkeypatch.setattr(V, "ENCODED", 16)

    class Counting(V.HashBag):
        def encode_batch(self, texts):
            assert len(texts) <= 16
            return super().encode_batch(texts)

    texts = spark.range(0, 100, 1, 1).selectExpr("id", "concat('w', id, ' x') AS text")
    made = V.to_bytes(V.embed(texts, Counting(8), "text"), 8).orderBy("id").collect()
    assert [bytes(r["embedding_bytes"]) for r in made] == [V.HashBag(8).encode(f"w{i} x").tobytes() for i in range(100)]
    odd = spark.createDataFrame([(1, [1.0, 2.0]), (2, None), (3, [3.0, None])], "id int, embedding array<float>").coalesce(1)
    got = [r["embedding_bytes"] for r in V.to_bytes(odd).orderBy("id").collect()]
    assert bytes(got[0]) == np.array([1, 2], np.float32).tobytes() and got[1] is None and np.isnan(np.frombuffer(got[2], np.float32)[1])
    with pytest.raises(Exception, match="a vector has 2 components, not 3"):
        V.to_bytes(odd, 3).collect()
