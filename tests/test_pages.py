"""Pages of long documents: rendering by ranges, and transcription with a bounded number of open requests."""

import threading
import time
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer

import pytest
from pyspark.sql import functions as F

from clausemill.sources import ocr, rasterise, store

PDFS = "document_id long, content binary"


def book(pages, lines=3):
    return bytearray("\n".join(f"page {k // lines + 1} line {k}" for k in range(pages * lines)).encode())


def test_a_long_document_spreads_over_tasks(spark):
    pdfs = spark.createDataFrame([(7, book(839)), (8, book(1)), (9, None), (10, bytearray(b""))], PDFS)
    renderer = rasterise.TextBook(3)
    cut = rasterise.parts(pdfs, renderer, 32)
    assert [(r["document_id"], r["first"]) for r in cut.orderBy("document_id", "first").collect()] == [(7, k) for k in range(1, 840, 32)] + [(8, 1), (10, 1)]
    made = rasterise.render(pdfs, "o", 72, renderer, 32).withColumn("task", F.spark_partition_id()).collect()
    assert sorted(r["page_ordinal"] for r in made if r["document_id"] == 7) == list(range(1, 840)) and len(made) == 841
    assert len({r["task"] for r in made if r["document_id"] == 7}) == 4
    page = next(r for r in made if r["document_id"] == 7 and r["page_ordinal"] == 500)
    assert bytes(page["image"]).split(b"\n")[1] == b"page 500 line 1497" and page["image_path"] == "o/doc7/page0500.png" and page["height"] == 36


def test_stage_is_done_again_after_a_failure(spark, tmp_path):
    class Breaks(rasterise.TextBook):
        """Fails at one part until a file is there."""

        def __init__(self, flag):
            super().__init__(3)
            self.flag = flag

        def __call__(self, content, dpi):
            if b"page 5 " in content and not self.flag.exists():
                raise RuntimeError("this part can't be read")
            yield from rasterise.TextBook.__call__(self, content, dpi)

    books, flag, out = store.Store(spark, str(tmp_path / "db")), tmp_path / "mended", str(tmp_path / "out")
    first = spark.createDataFrame([(1, book(9))], PDFS)
    with pytest.raises(Exception, match="can't be read"):
        rasterise.pages_stage(books, first, out, 72, Breaks(flag), 4)
    assert books.read("pages").count() == 0
    flag.write_text("")
    assert rasterise.pages_stage(books, first, out, 72, Breaks(flag), 4) == 9
    both = spark.createDataFrame([(1, book(9)), (2, book(3))], PDFS)
    assert rasterise.pages_stage(books, both, out, 72, Breaks(flag), 4) == 3
    images = rasterise.read_images(spark, out)
    assert images.count() == 12 and images.where("document_id = 2 AND page_ordinal = 3").count() == 1
    marks = books.read("checkpoints").where("stage = 'pages' AND status = 'done'")
    assert marks.where("unit_id = 0").count() == 2 and marks.where("unit_id > 0").count() == 12


@pytest.fixture
def server():
    """Answers late, drops every page's first request, refuses page 7 always; knows how many requests were open at once."""
    state = {"open": 0, "most": 0, "asked": {}}
    lock = threading.Lock()

    class Answer(BaseHTTPRequestHandler):
        def do_POST(self):
            text = self.rfile.read(int(self.headers["Content-Length"])).decode()
            page = text.split("base64,")[1].split('"')[0]
            with lock:
                state["open"] += 1
                state["most"] = max(state["most"], state["open"])
                state["asked"][page] = n = state["asked"].get(page, 0) + 1
            time.sleep(0.05)
            good = n > 1 and page != "Nw=="  # the seventh picture
            with lock:
                state["open"] -= 1
            self.send_response(200 if good else 503)
            self.end_headers()
            if good:
                self.wfile.write(f'data: {{"choices": [{{"delta": {{"content": "text of {page}"}}}}]}}\n\ndata: [DONE]\n'.encode())

        def log_message(self, *_):
            pass

    web = ThreadingHTTPServer(("127.0.0.1", 0), Answer)
    threading.Thread(target=web.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{web.server_port}/v1", state
    web.shutdown()


def test_requests_are_bounded_and_repeated(spark, server):
    url, state = server
    pages = spark.createDataFrame([(1, k, f"p{k}.png") for k in range(1, 25)], "document_id long, page_ordinal int, image_path string")
    images = spark.createDataFrame([(1, k, bytearray(str(k).encode())) for k in range(1, 25)], "document_id long, page_ordinal int, image binary")
    made = ocr.transcribe(pages, ocr.HttpBackend(url), None, images, in_flight=3, most_open=6, tries=3, wait=0.01).collect()
    assert sorted(r["page_ordinal"] for r in made) == list(range(1, 25))
    failed = [r for r in made if r["status"] == "failed"]
    assert [r["page_ordinal"] for r in failed] == [7] and "503" in failed[0]["error"]
    assert {r["page_ordinal"]: r["raw_text"] for r in made if r["page_ordinal"] in (1, 10)} == {1: "text of MQ==", 10: "text of MTA="}
    assert 2 <= state["most"] <= 6 and state["asked"]["MQ=="] == 2 and state["asked"]["Nw=="] == 3


def test_a_fault_of_the_backend_is_no_failed_page(spark):
    class Faulty:
        name = "faulty"

        def transcribe(self, image_path, page_ordinal):
            return {}["blocks"]

    pages = spark.createDataFrame([(1, 1, "p1.png")], "document_id long, page_ordinal int, image_path string")
    with pytest.raises(Exception, match="KeyError"):
        ocr.transcribe(pages, Faulty()).collect()


def test_a_documents_pages_are_written_together(spark, tmp_path):
    rows = [(d, p, f"{d}/{p}") for d in range(40) for p in (1, 2, 3)] + [(99, p, f"99/{p}") for p in range(64)]
    pages = spark.createDataFrame(rows, "document_id long, page_ordinal int, raw_text string")
    ocr.write_page_files(pages, str(tmp_path / "files"))
    files = [p for p in (tmp_path / "files").rglob("*") if p.is_file() and p.parent != tmp_path / "files"]
    assert len(files) == len(rows) and all(p.name.endswith(".json") for p in files)  # and no checksum files
    tasks = lambda d: {p.name[:10] for p in files if p.parent.parent.name == f"doc={d}"}
    assert all(len(tasks(d)) == 1 for d in range(40)) and len(tasks(99)) > 4  # a long document goes to several
    assert sorted((r["document_id"], r["page_ordinal"], r["raw_text"]) for r in ocr.read_page_files(spark, str(tmp_path / "files")).collect()) == sorted(rows)
