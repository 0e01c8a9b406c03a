import base64
import gzip
import hashlib
import io
import random

import pytest
from pyspark.sql import functions as F

from clausemill.llm import warc

PAGES = "page_id long, url string, html string, origin string, name int"


def pages_of(spark):
    rng = random.Random(3)
    long = "".join(rng.choice("abc đ😀\r\n") for _ in range(70_000))
    rows = [
        (1, "http://a/ b\n", long, "o", 1),
        (2, "http://b/", long, "o", 1),
        (3, None, None, None, None),
        (4, "http://c/", "", "o", 1),
        (5, "http://d/", "WARC/1.1\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n0\r\n\r\n", "o", 2),
        (6, "http://e/", "short", "o", 2),
        (6, "http://e/", "short", "o", 2),
        (0, "http://f/", "short", "o", 2),
        (7, "http://g/", "short ", "o", 2),
        (None, "http://h/", "short", None, 3),
        (None, None, None, None, 3),
    ]
    return spark.createDataFrame(rows, PAGES), rows


def brute(rows, least=0):
    first, out = {}, []
    for i, _, html, *_ in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        data = (html or "").encode()
        told = (i, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode())
        if i is None or len(data) < least or data not in first:
            out.append((*told, "response", None))
            if i is not None:
                first.setdefault(data, i)
        else:
            out.append((*told, "revisit", first[data]))
    return sorted(out, key=repr)


def read_back(spark, path, payload=False):
    page = lambda c: warc.page_of(c).try_cast("long")
    return warc.read_archives(spark, path, payload).withColumn("page_id", page("record_id")).withColumn("refers_to", page("refers_to"))


@pytest.mark.parametrize("segment,chunk,least", [(16 << 10, 4 << 10, 0), (100, 7, 0), (5000, 1 << 20, 6)])
def test_round_trip(spark, tmp_path, segment, chunk, least):
    pages, rows = pages_of(spark)
    path = str(tmp_path / "a")
    warc.write_archives(pages, path, least=least, segment_bytes=segment, chunk_bytes=chunk)
    found = read_back(spark, path, payload=True).collect()
    assert sorted([(r["page_id"], r["payload_bytes"], r["payload_digest"], r["type"], r["refers_to"]) for r in found], key=repr) == brute(rows, least)
    assert all(r["error"] is None for r in found)
    assert all(r["segments"] > r["payload_bytes"] // segment for r in found if r["type"] == "response")
    texts = {(i, (html or "").encode()) for i, _, html, *_ in rows}
    assert all((r["page_id"], bytes(r["payload"])) in texts for r in found if r["type"] == "response")
    assert warc.read_archives(spark, path).where("payload IS NOT NULL").count() == 0


def test_archives_are_whole_records(spark, tmp_path):
    """Each file can be read by itself, record by record; ids differ; segments of a block may lie in several files."""
    pages, _ = pages_of(spark)
    path = tmp_path / "a"
    warc.write_archives(pages.where("page_id = 1"), str(path), segment_bytes=1000)
    raw = [x for f in sorted(path.glob("*.gz")) for x in warc.records(io.BytesIO(gzip.decompress(f.read_bytes())))]
    assert len({f["warc-record-id"] for f, _ in raw}) == len(raw) > 60
    assert [int(f["warc-segment-number"]) for f, _ in raw] == list(range(1, len(raw) + 1))
    assert int(raw[-1][0]["warc-segment-total-length"]) == sum(len(b) for _, b in raw)
    assert b"".join(b for _, b in raw).startswith(b"HTTP/1.1 200 OK\r\n") and raw[0][0]["warc-target-uri"] == "http://a/%20b%0A"
    # The same records one by one, in files of any order and some twice.
    rng = random.Random(1)
    mixed = [*raw, *raw[:5]]
    rng.shuffle(mixed)
    for k in range(0, len(mixed), 7):
        out = io.BytesIO()
        for fields, block in mixed[k : k + 7]:
            out.write(b"WARC/1.1\r\n" + b"".join(f"{a}: {b}\r\n".encode() for a, b in fields.items()) + b"\r\n" + block + b"\r\n\r\n")
        (tmp_path / f"b{k}.warc").write_bytes(out.getvalue())
    one = warc.read_archives(spark, str(tmp_path / "b*.warc")).collect()
    assert len(one) == 1 and one[0]["error"] is None and one[0]["payload_bytes"] == warc.read_archives(spark, str(path)).first()["payload_bytes"]


def foreign(*records):
    out = b""
    for fields, block in records:
        out += b"WARC/1.0\r\n" + "".join(f"{k}: {v}\r\n" for k, v in {**fields, "Content-Length": len(block)}.items()).encode() + b"\r\n" + block + b"\r\n\r\n"
    return out


def segments(name, parts, total=None, skip=()):
    rows = []
    for k, part in enumerate(parts, 1):
        fields = {"WARC-Type": "response" if k == 1 else "continuation", "WARC-Record-ID": f"<urn:page:{name}:x{k}>", "WARC-Segment-Number": k}
        if k > 1:
            fields["WARC-Segment-Origin-ID"] = f"<urn:page:{name}:x1>"
        if k == len(parts) and total is not None:
            fields["WARC-Segment-Total-Length"] = total
        if k not in skip:
            rows.append((fields, part))
    return rows


def test_what_is_wrong_is_said(spark, tmp_path):
    head = b"HTTP/1.1 200 OK\r\nTransfer-Encoding: gzip, chunked\r\n\r\n"
    good = [head + b"3;x=y\r\nab", b"c\r", b"\n2\r\nde\r\n0\r\nTrailer: 1\r\n\r\n"]
    size = sum(map(len, good))
    data = foreign(
        ({"WARC-Type": "warcinfo", "WARC-Record-ID": "<urn:info>"}, b"software: x"),
        *segments("1", good, size),
        *segments("2", good, size, skip=(2,)),
        *segments("3", good, size + 1),
        *segments("4", good),
        *segments("5", good, size, skip=(1,)),
        ({"WARC-Type": "response", "WARC-Record-ID": "<urn:page:6:x>"}, head + b"zz\r\nabc"),
        ({"WARC-Type": "response", "WARC-Record-ID": "<urn:page:7:x>"}, head + b"3\r\nabcd\r\n0\r\n\r\n"),
        ({"WARC-Type": "response", "WARC-Record-ID": "<urn:page:8:x>"}, head + b"3\r\nabc\r\n"),
        ({"WARC-Type": "response", "WARC-Record-ID": "<urn:page:9:x>", "WARC-Payload-Digest": "sha1:AAAA"}, b"HTTP/1.0 200 OK\r\n\r\nplain"),
        ({"WARC-Type": "response", "WARC-Record-ID": "<urn:page:10:x>"}, b"HTTP/1.0 200 OK\r\n\r\nplain"),
        ({"WARC-Type": "response", "WARC-Record-ID": "<urn:page:11:x>"}, b"no head"),
    )
    (tmp_path / "x.warc").write_bytes(data)
    (tmp_path / "y.warc.gz").write_bytes(b"".join(gzip.compress(foreign(r)) for r in segments("12", good, size)))
    said = {r["record_id"].split(":")[2] if "page" in r["record_id"] else "info": r for r in warc.read_archives(spark, str(tmp_path)).collect()}
    wrong = {k: r["error"] for k, r in said.items()}
    assert wrong["1"] is None and wrong["10"] is None and wrong["12"] is None and wrong["info"] is None
    assert said["1"]["payload_bytes"] == said["12"]["payload_bytes"] == 5 and said["1"]["payload_digest"] == warc.base32_sha1(b"abcde") and said["1"]["segments"] == 3
    assert said["10"]["payload_bytes"] == 5 and said["info"]["payload_bytes"] is None
    assert wrong["2"] == "segment 2 is missing" and wrong["5"] == "segment 1 is missing" and wrong["4"] == "the last segment is missing"
    assert wrong["3"] == f"the segments have {size} bytes, not {size + 1}"
    assert "size" in wrong["6"] and "size says" in wrong["7"] and wrong["8"] == "the last chunk is missing" and "digest" in wrong["9"] and "head" in wrong["11"]


def test_payload_in_any_parts():
    rng = random.Random(5)
    body = bytes(rng.randrange(256) for _ in range(3000))
    block = b"HTTP/1.1 200 OK\r\ntransfer-encoding: Chunked\r\n\r\n" + b"".join(b"%X\r\n%b\r\n" % (len(c), c) for c in (body[:1], body[1:900], body[900:])) + b"0\r\n\r\n"
    for _ in range(50):
        message = warc.Payload(True)
        at = 0
        while at < len(block):
            k = rng.choice([1, 2, 3, 50, 1000])
            message.feed(block[at : at + k])
            at += k
        assert message.end() is None and b"".join(message.body) == body


def test_files_that_are_no_archives(spark, tmp_path, docs):
    (tmp_path / "x.warc").write_bytes(b"hello\r\n")
    with pytest.raises(Exception, match="no record begins with"):
        warc.read_archives(spark, str(tmp_path / "x.warc")).collect()
    (tmp_path / "y.warc").write_bytes(foreign(({"WARC-Type": "response"}, b"abc"))[:-6])
    with pytest.raises(Exception, match="has 1 bytes, not 3"):
        warc.read_archives(spark, str(tmp_path / "y.warc")).collect()


def test_no_pages_and_clashing_names(spark, tmp_path, docs):
    """Ids of another kind, and columns named like ours."""
    pages, _ = pages_of(spark)
    warc.write_archives(pages.where("false"), str(tmp_path / "none"))
    assert warc.read_archives(spark, str(tmp_path / "none")).count() == 0
    odd = pages.where("page_id IS NOT NULL").select(F.col("page_id").alias("name"), "url", F.col("html").alias("hash"), F.lit(1).alias("payload"), F.lit(2).alias("first"), F.lit(3).alias("__c0"))
    warc.write_archives(odd, str(tmp_path / "odd"), page_id="name", html="hash")
    assert read_back(spark, str(tmp_path / "odd")).where("type = 'revisit'").count() == 4
