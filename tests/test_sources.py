import json

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from clausemill.operators import stages
from clausemill.operators import vectors as V
from clausemill.schemas import OCR_PAGES
from clausemill.sources import markup, ocr, rasterise, store
from clausemill.streaming import ingest


def pages(spark, text):
    files = spark.createDataFrame([(1, text)], "document_id long, value string")
    return {r["page_ordinal"]: r["raw_text"] for r in markup.split_pages(files).collect()}


def test_batches(spark):
    text = "dropped\n<!-- page 1-3 -->\n\n<PAGE>one\n<PAGE>two\nlines\n<PAGE>three\n<!-- page 4-4 -->\n<PAGE>four\n<!-- page 5-6 -->\n<PAGE>five\n"
    assert pages(spark, text) == {1: "one", 2: "two\nlines", 3: "three", 4: "four", 5: "five"}


def test_surplus_marks_and_preamble_are_dropped(spark):
    assert pages(spark, "<!-- page 1-1 -->\npreamble\n<PAGE>one\n<PAGE>more") == {1: "one"}


def test_later_batches_win(spark):
    assert pages(spark, "<!-- page 1-1 -->\n<PAGE>old\n<!-- page 1-1 -->\n<PAGE>new") == {1: "new"}


def test_a_file_without_batches_fails(spark):
    with pytest.raises(PySparkException, match="no page markers"):
        pages(spark, "<PAGE>one")


def test_a_later_batch_without_a_mark_empties_its_pages(spark):
    registered = spark.createDataFrame([(1, p) for p in (1, 2, 3, 9)], "document_id long, page_ordinal int")
    text = "<!-- page 1-3 -->\n<PAGE>a\n<PAGE>b\n<PAGE>c\n<!-- page 2-2000000000 -->\n<PAGE>new\n<!-- page 8-7 -->\n<PAGE>x"
    files = spark.createDataFrame([(1, text)], "document_id long, value string")
    got = {r["page_ordinal"]: r["raw_text"] for r in markup.import_pages(registered, files).collect()}
    assert got == {1: "a", 2: "new", 3: "", 9: ""}


def test_cleaning(spark):
    text = "<|det|>page_number [1,2]<|/det|> 12\n<|det|>title [3]<|/det|>Điều 2. Đối tượng\n  [Non-Text] \nxong\n"
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(markup.cleaned(F.col("t"))).first()[0] == "Điều 2. Đối tượng\nxong"


def test_import_leaves_done_pages(spark):
    registered = spark.createDataFrame([(1, p) for p in (1, 2, 3)], "document_id long, page_ordinal int")
    files = spark.createDataFrame([(1, "<!-- page 1-3 -->\n<PAGE>a\n<PAGE>b")], "document_id long, value string")
    done = spark.createDataFrame([(1, 1)], "document_id long, page_ordinal int")
    got = markup.import_pages(registered, files, done).collect()
    assert {(r["page_ordinal"], r["raw_text"]) for r in got} == {(2, "b"), (3, "")}


EVENTS = ['data: {"choices": [{"delta": {"content": "Điều "}}]}', "", "data: {bad", 'data: {"choices": []}', '{"choices": [{"delta": {"content": "1"}}]}', "data: [DONE]", 'data: {"choices": [{"delta": {"content": "x"}}]}']


def test_streams(spark):
    assert ocr.decode_stream(EVENTS) == "Điều 1"
    df = spark.createDataFrame([(1, k, e) for k, e in enumerate(EVENTS)], "key long, at int, line string")
    assert ocr.decoded_streams(df, "key").first()["text"] == "Điều 1"


def test_http_backend(tmp_path):
    image = tmp_path / "p.PNG"
    image.write_bytes(b"\x01\x02")
    sent = {}
    backend = ocr.HttpBackend("http://x/v1/", logit_processor="lp", post=lambda url, body: sent.update(url=url, body=body) or EVENTS)
    assert backend.transcribe(str(image), 1)["raw_text"] == "Điều 1"
    assert sent["url"] == "http://x/v1/chat/completions" and sent["body"]["temperature"] == 0 and sent["body"]["custom_params"] == {"ngram_size": 35, "window_size": 128}
    assert sent["body"]["messages"][0]["content"][1]["image_url"]["url"] == "data:image/png;base64,AQI="

    def refuse(url, body):
        raise ConnectionRefusedError("no")

    with pytest.raises(RuntimeError, match="can't be reached"):
        ocr.HttpBackend(post=refuse).transcribe(str(image), 1)


def test_json_records(spark, tmp_path):
    df = spark.createDataFrame([(1, 9, json.dumps({"page_ordinal": 3, "image_path": "i"}))], "document_id long, page_ordinal int, json string")
    r = ocr.from_json(df).first()
    assert (r["page_ordinal"], r["blocks"], r["raw_text"]) == (9, [], "")
    assert ocr.read_artifacts(spark, str(tmp_path / "nothing")).count() == 0
    ocr.write_artifacts(ocr.from_json(df), str(tmp_path / "a"))
    assert ocr.read_artifacts(spark, str(tmp_path / "a"), 1).count() == 1


def test_transcription_goes_on_after_a_failure(spark):
    class Flaky:
        name = "flaky"

        def transcribe(self, image_path, page_ordinal):
            if page_ordinal == 2:
                raise RuntimeError("bad page")
            return ocr.StubBackend().transcribe(image_path, page_ordinal)

    df = spark.createDataFrame([(1, 1, "a/p1.png"), (1, 2, "a/p2.png"), (1, 3, "p3.png")], "document_id long, page_ordinal int, image_path string")
    done = spark.createDataFrame([(1, "ocr", 3, "done"), (1, "ocr", 2, "failed")], "document_id long, stage string, unit_id long, status string")
    got = {r["page_ordinal"]: r for r in ocr.transcribe(df, Flaky(), done).collect()}
    assert set(got) == {1, 2} and got[2]["error"] == "bad page" and got[1]["raw_text"] == "[stub OCR] page=1 image=p1.png"
    assert got[1]["blocks"][0]["bbox"] == [0.0] * 4


def test_completed(spark):
    rows = [(k, "done") for k in (0, 1, 2, 3, 5)] + [(4, "failed")]
    df = spark.createDataFrame(rows, "unit_id long, status string")
    assert {r["unit_id"] for r in store.completed(df).collect()} == {1, 2, 3, 5}


def test_store(spark, tmp_path):
    books = store.Store(spark, str(tmp_path / "db"))
    books.init()
    books.register(spark.createDataFrame([("b", None), ("a", "t"), ("a", "t")], "source_path string, title string"))
    books.register(spark.createDataFrame([("a", "u"), ("c", None)], "source_path string, title string"))
    assert {(r["source_path"], r["document_id"]) for r in books.read("documents").collect()} == {("a", 1), ("b", 2), ("c", 3)}
    text = "Điều 1. Tổ chức theo Điều 2 bị phạt tiền\nĐiều 2. Cá nhân nộp thuế; xong"
    page = spark.createDataFrame([(1, 1, text)], "document_id long, page_ordinal int, raw_text string")
    for _ in range(2):
        ingest.structure(books, page)
        assert books.read("clauses").count() == 2 and books.read("clause_references").count() == 1
    first = stages.run_cards(books)
    assert (first["clauses_scanned"], first["cards_inserted"], first["skipped"], first["ok"]) == (2, 2, 0, True)
    again = stages.run_cards(books)
    assert (again["cards_inserted"], again["skipped"]) == (0, 2) and books.read("rule_cards").count() == 2
    assert stages.run_embed(books, V.HashBag(64))["embedded"] == 2 and stages.run_embed(books, V.HashBag(64))["skipped"] == 2
    assert not stages.check_dimensions(books, 128)["ok"] and stages.check_dimensions(books, 64)["ok"]
    ids = {r["citation"]: r["clause_id"] for r in books.read("clauses").collect()}
    ingest.structure(books, page.withColumn("raw_text", F.lit("Điều 1. Tổ chức khác\nĐiều 2. Cá nhân nộp thuế; xong")))
    assert {r["citation"]: r["clause_id"] for r in books.read("clauses").collect()} == ids
    assert stages.run_cards(books)["cards_inserted"] == 1
    assert books.delete_documents(spark.createDataFrame([(1,)], "document_id long")) == 2 and books.read("clause_references").count() == 0
    with pytest.raises(PySparkException, match="kind is section"):
        books.write("clauses", spark.createDataFrame([(1, "section")], "clause_id long, kind string"))


def test_ids_stay_when_pages_come_out_of_order(spark, tmp_path):
    books = store.Store(spark, str(tmp_path / "db"))
    pages = {1: "Điều 1. một theo Điều 3\nKhoản 1. x", 2: "Điều 2. hai theo Điều 1 và Điều 9\nKhoản 1. y", 3: "Điều 3. ba\n  a) z"}
    page = lambda *ks: spark.createDataFrame([(7, k, pages[k]) for k in ks], "document_id long, page_ordinal int, raw_text string")
    ingest.structure(books, page(2))
    before = {r["citation"]: r["clause_id"] for r in books.read("clauses").collect()}
    refs = {(r["src_clause_id"], r["target_citation"]): r["reference_id"] for r in books.read("clause_references").collect()}
    ingest.structure(books, page(2, 3))
    ingest.structure(books, page(1, 2, 3))
    rows = {r["citation"]: r for r in books.read("clauses").collect()}
    assert set(rows) == {"Điều 1", "Khoản 1 Điều 1", "Điều 2", "Khoản 1 Điều 2", "Điều 3", "Điểm a Điều 3"}
    assert len({r["clause_id"] for r in rows.values()}) == 6 and all(r["clause_id"] >> 24 == 7 for r in rows.values())
    assert all(rows[c]["clause_id"] == k for c, k in before.items())
    for child in ("Khoản 1 Điều 1", "Khoản 1 Điều 2", "Điểm a Điều 3"):
        assert rows[child]["parent_id"] == rows[child[-6:]]["clause_id"]
    got = {(r["src_clause_id"], r["target_citation"]): r for r in books.read("clause_references").collect()}
    assert len({r["reference_id"] for r in got.values()}) == len(got) == 3 and all(got[k]["reference_id"] == v for k, v in refs.items())
    assert got[rows["Điều 1"]["clause_id"], "Điều 3"]["dst_clause_id"] == rows["Điều 3"]["clause_id"]


def test_changes_write_only_the_buckets_they_touch(spark, tmp_path):
    books = store.Store(spark, str(tmp_path / "db"))
    rows = spark.range(1, 300).select(F.col("id").alias("document_id"), F.lit(0).alias("unit_id"), F.lit("done").alias("status"))
    books.mark(rows, "ocr")
    books.mark(rows.where("document_id = 5").withColumn("status", F.lit("failed")), "ocr")
    last = books._manifest("checkpoints", books._versions("checkpoints")[-1])
    assert sorted(last.values()).count(2) == 1 and len(last) > 50
    assert books.read("checkpoints").count() == 299 and books.by("checkpoints", document_id=5).first()["status"] == "failed"
    with pytest.raises(PySparkException, match="status is bad"):
        books.mark(rows.limit(1).withColumn("status", F.lit("bad")), "ocr")
    assert books.read("checkpoints").count() == 299


def test_a_path_twice_is_an_error(spark, tmp_path):
    books = store.Store(spark, str(tmp_path / "db"))
    one = spark.createDataFrame([("a", None)], "source_path string, title string")
    books.insert(one)
    for bad in (one, one.withColumn("source_path", F.lit("b")).union(one.withColumn("source_path", F.lit("b")))):
        with pytest.raises(ValueError, match="already"):
            books.insert(bad)
    assert books.read("documents").count() == 1


def test_artifacts(spark, tmp_path):
    from clausemill.operators import clauses as K
    from clausemill.sources import artifacts

    pages = spark.createDataFrame([(1, 1, "Điều 1. \"a\"\nKhoản 2. b"), (1, 4, "  a) c"), (2, 1, "văn xuôi")], "document_id long, page_ordinal int, raw_text string")
    parsed = K.parse_pages(pages)
    artifacts.write(artifacts.clause_graphs(pages.withColumn("page", F.col("page_ordinal")), parsed, K.stored(parsed)), str(tmp_path), "clauses.json")
    text = {json.loads(r["value"])["document_id"]: json.loads(r["value"]) for r in spark.read.text(str(tmp_path / "clauses.json")).collect()}
    assert text[2] == {"document_id": 2, "page_count": 1, "clauses": []} and text[1]["page_count"] == 4
    assert [(c["citation"], c["parent_number"], c["id"] & 0xFFFFFF) for c in text[1]["clauses"]] == [("Điều 1", None, 1), ("Khoản 2 Điều 1", ["1"], 2), ("Điểm a Khoản 2 Điều 1", ["1", "2"], 3)]
    cards = spark.createDataFrame([(9, 8, 1, "s", [1.0]), (7, 6, 1, "t", None)], "card_id long, clause_id long, document_id long, statement string, embedding array<float>")
    artifacts.write(artifacts.card_files(pages.select("document_id").distinct(), cards), str(tmp_path), "cards.json")
    back = {r["document_id"]: r for r in artifacts.read(spark, str(tmp_path), "cards.json", artifacts.CARDS).collect()}
    assert back[2]["card_count"] == 0 and [(c["id"], c["has_embedding"]) for c in back[1]["cards"]] == [(7, False), (9, True)]


def test_a_cluster_must_name_its_shared_folder():
    from types import SimpleNamespace

    from clausemill.sources.scratch import shared_folder

    made = lambda master, named: SimpleNamespace(conf=SimpleNamespace(get=lambda *_: named), sparkContext=SimpleNamespace(master=master, getCheckpointDir=lambda: None, setCheckpointDir=lambda _: None))
    for master in ("yarn", "spark://host:7077", "local-cluster[2,1,1024]", "k8s://https://host"):
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            shared_folder(made(master, None))
        assert shared_folder(made(master, "hdfs://x/y/")) == "hdfs://x/y"
    assert all("clausemill-" in shared_folder(made(master, None)) for master in ("local", "local[4]", "local[*]"))


def test_another_extractor(spark, tmp_path):
    from clausemill.operators import cards as C

    books = store.Store(spark, str(tmp_path / "db"))
    ingest.structure(books, spark.createDataFrame([(1, 1, "Điều 1. Tổ chức nộp thuế\nĐiều 2. Cá nhân nộp thuế")], "document_id long, page_ordinal int, raw_text string"))
    blank = lambda rows: C.extract(rows).withColumn("statement", F.when(F.col("citation") == "Điều 2", " ").otherwise("said"))
    row = stages.run_cards(books, extractor=blank)
    assert (row["cards_inserted"], row["failed"], row["ok"]) == (1, 1, False) and books.read("rule_cards").first()["statement"] == "said"


def test_embedding_again_what_has_another_dimension(spark, tmp_path):
    books = store.Store(spark, str(tmp_path / "db"))
    ingest.structure(books, spark.createDataFrame([(1, 1, "Điều 1. Tổ chức nộp thuế\nĐiều 2. Cá nhân nộp thuế")], "document_id long, page_ordinal int, raw_text string"))
    stages.run_cards(books)

    class Other(V.HashBag):
        def encode_batch(self, texts):
            return V.HashBag(32).encode_batch(texts)

    row = stages.run_embed(books, Other(64))
    assert (row["embedded"], row["mismatched"], row["failed"], row["ok"]) == (0, 2, 0, False)
    row = stages.run_embed(books, V.HashBag(64))
    assert (row["cards_scanned"], row["embedded"], row["skipped"], row["ok"]) == (2, 2, 0, True)


def test_stream(spark, tmp_path):
    source = tmp_path / "in"
    ocr.write_artifacts(spark.createDataFrame([(4, 1, "Điều 1. a"), (4, 2, "Khoản 1. b")], "document_id long, page_ordinal int, raw_text string"), str(source))
    books = store.Store(spark, str(tmp_path / "db"))
    for _ in range(2):
        ingest.ingest(spark, str(source), books, str(tmp_path / "marks")).awaitTermination()
        assert books.read("clauses").count() == 2


def test_rendering(spark, tmp_path):
    books = store.Store(spark, str(tmp_path / "db"))
    pdfs = spark.createDataFrame([(1, bytearray(b"x"))], "document_id long, content binary")
    draw = lambda content, dpi: [(1, 10, 20, b"a"), (2, 10, 20, b"b")]
    assert rasterise.pages_stage(books, pdfs, str(tmp_path / "out"), 72, draw, files=True) == 2
    assert rasterise.pages_stage(books, pdfs, str(tmp_path / "out"), 72, draw, files=True) == 0
    assert (tmp_path / "out/doc1/page0002.png").read_bytes() == b"b"


def test_a_file_for_each_page(spark, tmp_path):
    """Files as Spark writes them and as other programs do; the ordinal of the name wins, and other files are no pages."""
    pages = [(7, 1, "p.png", [("text", [0.0], "a")], "a\nb"), (7, 12, None, None, None), (8, 1, None, None, "c"), (8, 1, None, None, "d")]
    out = tmp_path / "ocr"
    ocr.write_page_files(spark.createDataFrame(pages, OCR_PAGES), str(out))
    assert len(list(out.glob("doc=*/page=*/*.json"))) == 3
    other = out / "doc9"
    other.mkdir()
    (other / "page0003.json").write_text(json.dumps({"page_ordinal": 44, "image_path": "x", "blocks": [], "raw_text": "Điều 1. ấ"}, indent=2, ensure_ascii=False), encoding="utf-8")
    (other / "clauses.json").write_text("{}")
    (other / "page0004.json").write_text("")
    got = sorted((r["document_id"], r["page_ordinal"], r["image_path"], len(r["blocks"]), r["raw_text"]) for r in ocr.read_page_files(spark, str(out)).collect())
    assert got == [(7, 1, "p.png", 1, "a\nb"), (7, 12, None, 0, ""), (8, 1, None, 0, "d"), (9, 3, "x", 0, "Điều 1. ấ")]
    assert [r["raw_text"] for r in ocr.read_page_files(spark, str(out), 9).collect()] == ["Điều 1. ấ"]
    assert ocr.read_page_files(spark, str(tmp_path / "none")).count() == 0


def test_page_files_are_written_by_many_tasks(spark, tmp_path):
    """Small pages too: what takes time is the number of files. A long document is no single task either."""
    pages = spark.range(40).select((F.col("id") % 1 + 7).alias("document_id"), F.col("id").cast("int").alias("page_ordinal"), F.lit("x").alias("raw_text"))
    ocr.write_page_files(pages, str(tmp_path / "ocr"))
    files = list((tmp_path / "ocr").glob("doc=7/page=*/*.json"))
    assert len(files) == 40 and len({f.name.split("-")[1] for f in files}) >= 8
