"""Page records, transcription backends and the stage that runs them over all pending pages."""

from __future__ import annotations

import base64
import json
import os
import time
import urllib.error
import urllib.request
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from typing import Protocol, runtime_checkable

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import OCR_PAGES
from . import store

STUB_PREFIX = "[stub OCR] page="
PAGE_JSON = T.StructType([f for f in OCR_PAGES.fields if f.name not in ("document_id",)])


@runtime_checkable
class Backend(Protocol):
    """Transcribes one page image; the same input gives the same text. Used inside a task, so it must pickle.

    A backend may also have ``transcribe_image(image_path, page_ordinal, image)``, which takes the picture's bytes.
    """

    name: str

    def transcribe(self, image_path: str, page_ordinal: int) -> dict: ...


class StubBackend:
    name = "stub"

    def transcribe(self, image_path: str, page_ordinal: int) -> dict:
        text = f"{STUB_PREFIX}{page_ordinal} image={image_path.rsplit('/', 1)[-1]}"
        return {"blocks": [{"kind": "text", "bbox": [0.0, 0.0, 0.0, 0.0], "text": text}], "raw_text": text}


def stub_text(page_ordinal: Column, image_path: Column) -> Column:
    """The stub's text as an expression."""
    return F.format_string(f"{STUB_PREFIX}%d image=%s", page_ordinal, F.regexp_extract(image_path, "[^/]*$", 0))


class HttpBackend:
    """A chat-completion server that streams its answer.

    ``post`` (url, body) -> lines is the transport, so tests need no server; ``logit_processor`` is passed on as it is.
    Failures to connect and error statuses become RuntimeErrors that say how to start the server.
    """

    name = "http"

    def __init__(self, endpoint: str = "http://127.0.0.1:10000/v1", model: str = "Unlimited-OCR", prompt: str = "document parsing.", logit_processor: str | None = None, post: Callable | None = None):
        self.endpoint, self.model, self.prompt, self.logit_processor = endpoint.rstrip("/"), model, prompt, logit_processor
        self._post = post or self._send

    def body(self, image_path: str, image: bytes | None = None) -> dict:
        """``image`` holds the picture; without it, the path is a file that the task sees."""
        if image is None:
            with open(image_path, "rb") as f:
                image = f.read()
        data = base64.b64encode(image).decode()
        mime = "image/png" if image_path.lower().endswith(".png") else "image/jpeg"
        content = [{"type": "text", "text": self.prompt}, {"type": "image_url", "image_url": {"url": f"data:{mime};base64,{data}"}}]
        out = {"model": self.model, "messages": [{"role": "user", "content": content}], "temperature": 0, "stream": True, "skip_special_tokens": False, "images_config": {"image_mode": "gundam"}}
        if self.logit_processor is not None:
            out |= {"custom_logit_processor": self.logit_processor, "custom_params": {"ngram_size": 35, "window_size": 128}}
        return out

    def _send(self, url: str, body: dict) -> Iterator[str]:
        request = urllib.request.Request(url, json.dumps(body).encode(), {"Content-Type": "application/json"})
        with urllib.request.urlopen(request, timeout=300) as answer:
            for line in answer:
                yield line.decode("utf-8").rstrip("\r\n")

    def transcribe(self, image_path: str, page_ordinal: int) -> dict:
        return self.transcribe_image(image_path, page_ordinal, None)

    def transcribe_image(self, image_path: str, page_ordinal: int, image: bytes | None) -> dict:
        hint = "start the transcription server, or set another endpoint"
        try:
            text = decode_stream(self._post(f"{self.endpoint}/chat/completions", self.body(image_path, image)))
        except urllib.error.HTTPError as e:
            raise RuntimeError(f"{self.endpoint} answered {e.code}; {hint}") from e
        except (urllib.error.URLError, ConnectionError) as e:
            raise RuntimeError(f"{self.endpoint} can't be reached: {e}; {hint}") from e
        return {"blocks": [], "raw_text": text}


def decode_stream(lines) -> str:
    out = []
    for line in lines:
        line = line.removeprefix("data: ")
        if not line:
            continue
        if line == "[DONE]":
            break
        try:
            event = json.loads(line)
        except ValueError:
            continue
        choices = event.get("choices") or []
        piece = (choices[0].get("delta") or {}).get("content") if choices else None
        if piece:
            out.append(piece)
    return "".join(out)


def default_backend(variable: str = "CLAUSEMILL_OCR_ENDPOINT") -> Backend:
    endpoint = os.environ.get(variable)
    return HttpBackend(endpoint) if endpoint else StubBackend()


def decoded_streams(lines: DataFrame, key: str) -> DataFrame:
    """lines (key, at, line) -> key, text: event streams, decoded without Python.

    Lines from the first [DONE] on don't count; blank lines and what isn't an event with content give nothing.
    """
    said = F.regexp_replace("line", "^data: ", "")
    end = F.when(said == "[DONE]", F.col("at"))
    piece = F.get_json_object(said, "$.choices[0].delta.content")
    ordered = F.array_sort(F.collect_list(F.struct("at", F.coalesce(piece, F.lit("")).alias("piece"))))
    per = lines.groupBy(key).agg(ordered.alias("all"), F.min(end).alias("end"))
    kept = F.filter("all", lambda x: F.col("end").isNull() | (x["at"] < F.col("end")))
    return per.select(key, F.array_join(F.transform(kept, lambda x: x["piece"]), "").alias("text"))


# ---- records as JSON


def to_json(pages: DataFrame) -> DataFrame:
    return pages.select("document_id", "page_ordinal", F.to_json(F.struct("page_ordinal", "image_path", "blocks", "raw_text")).alias("json"))


def from_json(rows: DataFrame, ordinal: str = "page_ordinal") -> DataFrame:
    """rows (document_id, ordinal, json): the ordinal given, as from a file name, stands before the record's own."""
    r = F.from_json("json", PAGE_JSON)
    blocks = F.coalesce(r["blocks"], F.array().cast(OCR_PAGES["blocks"].dataType))
    return rows.select("document_id", F.col(ordinal).cast("int").alias("page_ordinal"), r["image_path"].alias("image_path"), blocks.alias("blocks"), F.coalesce(r["raw_text"], F.lit("")).alias("raw_text"))


def write_artifacts(pages: DataFrame, path: str) -> None:
    pages.write.mode("overwrite").partitionBy("document_id").json(path)


def read_artifacts(spark: SparkSession, path: str, document_id: int | None = None) -> DataFrame:
    """The pages under a path; empty where the path, or the document in it, doesn't exist."""
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    if not where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where):
        return spark.createDataFrame([], OCR_PAGES)
    rows = spark.read.schema(OCR_PAGES).json(path)
    return rows if document_id is None else rows.where(F.col("document_id") == document_id)


#: Pages of a document in one task, by ordinal; a long document goes to many.
PAGES_TOGETHER = 4


def write_page_files(pages: DataFrame, path: str) -> None:
    """One JSON file for each page, in folders by document and page; a page that comes twice has the record with the greatest text.

    Where no other program wants a file a page, ``write_artifacts`` makes far fewer. What a file costs doesn't hang on its bytes, so pages
    are dealt to a number of tasks that small tables have too. On a local disk, each folder and file costs a process that sets permissions: so
    runs of a document's pages go to one task, which makes its folder once, and no checksum files are written.
    """
    tasks = 4 * pages.sparkSession.sparkContext.defaultParallelism
    record = F.struct(*[F.col(c) if c in pages.columns else F.lit(None).cast(OCR_PAGES[c].dataType).alias(c) for c in ("page_ordinal", "image_path", "blocks", "raw_text")])
    dealt = pages.withColumn("run", F.floor((F.col("page_ordinal") - 1) / PAGES_TOGETHER)).repartition(tasks, "document_id", "run")
    one = dealt.groupBy("document_id", "run", "page_ordinal").agg(F.max_by(record, F.coalesce("raw_text", F.lit(""))).alias("r"))
    # The page's number stands in the record too, so the folders have columns of their own.
    one.select(F.col("document_id").alias("doc"), F.col("page_ordinal").alias("page"), "r.*").write.mode("overwrite").options(**_PLAIN_FILES).partitionBy("doc", "page").json(path)


#: For one write: local files as they are. File systems are kept by scheme, so this needs one that isn't.
_PLAIN_FILES = {"fs.file.impl": "org.apache.hadoop.fs.RawLocalFileSystem", "fs.file.impl.disable.cache": "true"}

#: Of which document and page a file is: doc7/page0003.json, or doc=7/page=3/part-....json as Spark writes it.
_PAGE_FILE = r"/doc=?(\d+)/page=?(\d+)(?:\.json|/[^/]*\.json)$"


def read_page_files(spark: SparkSession, path: str, document_id: int | None = None) -> DataFrame:
    """The pages of files under a path, whoever wrote them, on one line or many: document and ordinal are those of a file's name, whatever it says inside.

    Files of other names, and files without a byte, are no pages; a path that doesn't exist has none.
    """
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if not where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where):
        return spark.createDataFrame([], OCR_PAGES)
    # Folders are listed by tasks, of which there would be one for each.
    tasks = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    before = spark.conf.get(tasks)
    spark.conf.set(tasks, str(4 * spark.sparkContext.defaultParallelism))
    try:
        files = spark.read.text(path, wholetext=True, pathGlobFilter="*.json", recursiveFileLookup=True)
    finally:
        spark.conf.set(tasks, before)
    files = files.select(F.col("value").alias("json"), F.col("_metadata.file_path").alias("file"))
    part = lambda k: F.regexp_extract("file", _PAGE_FILE, k)
    named = files.where(F.rlike("file", F.lit(_PAGE_FILE))).select(part(1).cast("long").alias("document_id"), part(2).cast("int").alias("page_ordinal"), "json")
    rows = from_json(named if document_id is None else named.where(F.col("document_id") == document_id))
    return rows.select(*[f.name for f in OCR_PAGES.fields])


# ---- the stage


#: What a page may fail with; anything else is a fault of the backend's code and ends the stage.
PAGE_FAILURES = (RuntimeError, OSError, ValueError)


def attempt(backend: Backend, path: str, ordinal: int, image: bytes | None, tries: int, wait: float) -> tuple:
    """(blocks, raw_text, status, error) of one page, asked for again after growing waits."""
    for k in range(tries):
        try:
            page = backend.transcribe(path, ordinal) if image is None or not hasattr(backend, "transcribe_image") else backend.transcribe_image(path, ordinal, image)
            return page["blocks"], page["raw_text"], "done", None
        except PAGE_FAILURES as e:
            error = str(e)
            if k + 1 < tries:
                time.sleep(wait * 2**k)
    return [], "", "failed", error


def transcribe(
    pages: DataFrame, backend: Backend, checkpoints: DataFrame | None = None, images: DataFrame | None = None, *, in_flight: int = 1, most_open: int | None = None, tries: int = 1, wait: float = 0.5
) -> DataFrame:
    """Registered pages that aren't done -> document_id, page_ordinal, image_path, blocks, raw_text, status, error.

    A task keeps ``in_flight`` pages open at a time; with ``most_open`` the pages go to so many tasks that no more are open together. A page
    is asked for ``tries`` times. Failed pages are tried again the next time; one failure doesn't end the stage. ``images`` (document_id,
    page_ordinal, image) brings the pictures along, else the paths are files.
    """
    todo = pages.select("document_id", "page_ordinal", "image_path")
    if checkpoints is not None:
        done = checkpoints.where("stage = 'ocr'").withColumnRenamed("unit_id", "page_ordinal")
        todo = store.pending(todo, done, ["document_id", "page_ordinal"])
    if images is not None:
        todo = todo.join(images.select("document_id", "page_ordinal", "image"), ["document_id", "page_ordinal"], "left").select("document_id", "page_ordinal", "image_path", "image")
    if most_open is not None:
        in_flight = min(in_flight, most_open)
        todo = todo.repartition(max(1, most_open // in_flight))
    out = T.StructType([*OCR_PAGES.fields, T.StructField("status", T.StringType()), T.StructField("error", T.StringType())])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        with ThreadPoolExecutor(in_flight) as open_:
            for b in batches:
                pictures = b["image"] if "image" in b else [None] * len(b)
                asked = [open_.submit(attempt, backend, path, int(p), image, tries, wait) for p, path, image in zip(b["page_ordinal"], b["image_path"], pictures, strict=True)]
                rows = [(d, p, path, *x.result()) for d, p, path, x in zip(b["document_id"], b["page_ordinal"], b["image_path"], asked, strict=True)]
                yield pd.DataFrame(rows, columns=out.names)

    return todo.mapInPandas(run, out)


# ---- the registered queries


def sse_query(turns: DataFrame) -> DataFrame:
    """Turns as content events, with blank lines, bad JSON, events without content, and an end after the fifth turn."""
    event = F.to_json(F.struct(F.array(F.struct(F.struct(F.coalesce("text", F.lit("")).alias("content")).alias("delta"))).alias("choices")))
    line = (
        F.when(F.col("turn") == 5, "data: [DONE]").when(F.col("turn") % 4 == 3, F.concat(event, F.lit(""))).otherwise(F.concat(F.lit("data: "), event))
    )
    rows = turns.select("conv_id", (F.col("turn") * 3).alias("at"), line.alias("line"))
    noise = turns.select("conv_id", (F.col("turn") * 3 + 1).alias("at"), F.when(F.col("turn") % 3 == 0, "").when(F.col("turn") % 3 == 1, "data: {bad").otherwise('data: {"choices": []}').alias("line"))
    return decoded_streams(rows.union(noise), "conv_id").select("conv_id", F.md5("text").alias("text_md5"), F.length("text").alias("chars"))


SSE_SQL = """
WITH ended AS (SELECT *, max((turn = 5)::INTEGER) OVER (PARTITION BY conv_id) AS has_end FROM conversations)
SELECT conv_id, md5(t) AS text_md5, length(t)::INTEGER AS chars
FROM (SELECT conv_id, coalesce(string_agg(coalesce(text, ''), '' ORDER BY turn) FILTER (WHERE has_end = 0 OR turn < 5), '') AS t FROM ended GROUP BY conv_id)
"""


def roundtrip_query(turns: DataFrame) -> DataFrame:
    block = F.struct(F.col("role").alias("kind"), F.array(F.lit(0.0), F.lit(1.5), F.col("turn").cast("double"), F.lit(2.0)).alias("bbox"), F.col("text"))
    blocks = F.when(F.col("turn") % 2 == 0, F.array(block))
    pages = turns.select(F.col("conv_id").alias("document_id"), (F.col("turn") + 100).cast("int").alias("page_ordinal"), F.lit("p.png").alias("image_path"), blocks.alias("blocks"), F.when(F.col("turn") % 3 > 0, F.col("text")).alias("raw_text"))
    written = to_json(pages).withColumn("named", F.col("page_ordinal") - 99)
    back = from_json(written, "named")
    first = F.get("blocks", F.lit(0))
    return back.select("document_id", "page_ordinal", F.size("blocks").alias("blocks"), first["kind"].alias("kind"), F.get(first["bbox"], F.lit(2)).alias("x"), F.md5(first["text"]).alias("block_md5"), F.md5("raw_text").alias("text_md5"))


ROUNDTRIP_SQL = """
SELECT conv_id AS document_id, (turn + 1)::INTEGER AS page_ordinal, (turn % 2 = 0)::INTEGER AS blocks, CASE WHEN turn % 2 = 0 THEN role END AS kind,
       CASE WHEN turn % 2 = 0 THEN turn::DOUBLE END AS x, CASE WHEN turn % 2 = 0 THEN md5(text) END AS block_md5, md5(CASE WHEN turn % 3 > 0 THEN coalesce(text, '') ELSE '' END) AS text_md5
FROM conversations
"""
