import base64
import gzip
import hashlib

import pytest

from llm_cases import empty
from loomgraph.llm import warc_index as w
from loomgraph.llm.common import open_folder


@pytest.fixture(scope="module")
def pages(spark):
    rows = [
        (1, "http://A.com/x y", "<p>one</p>"), (2, "https://b.a.com:8080/", "<p>two é 日本</p>"), (3, "http://a.com/x y", "<p>one</p>"), (4, None, None), (5, None, ""), (6, "no scheme", "x" * 300000),
        (7, "http://a.com", "<p>one</p>"), (None, "http://n.com/", "<p>one</p>"), (8, "http://user@a.com/p?q#f", "line\r\n\r\nbreaks"), (9, "http://a.com/%", "only"), (9, "http://a.com/%", "only"),
        (None, "http://lonely.net/", "nobody else"),
    ]
    rows += [(100 + i, "http://hot.org/same" if i % 2 else None, f"page {i % 40}") for i in range(3000)]
    return spark.createDataFrame([(*r, "clash", "clash") for r in rows], "page_id long, url string, html string, key string, keeper string")


def expected(rows):
    first = {}
    for i, _, t in rows:
        if i is not None:
            first[t or ""] = min(i, first.get(t or "", i))
    out = []
    for i, _, t in rows:
        t = t or ""
        keeper = first.get(t)
        same = keeper is None or i == keeper
        digest = base64.b32encode(hashlib.sha1(t.encode()).digest()).decode()
        out.append((i, len(t.encode()), digest, "response" if same else "revisit", None if same else keeper))
    return sorted(out, key=str)


def test_read_back(spark, pages, monkeypatch):
    monkeypatch.setattr(w, "LINES", 50)
    monkeypatch.setattr(w, "SHARD", 400)
    rows = [(r.page_id, r.url, r.html) for r in pages.collect()]
    assert sorted(map(tuple, w.digest(pages).collect()), key=str) == expected(rows)
    assert w.digest(empty(spark).selectExpr("doc_id as page_id", "text as url", "text as html")).count() == 0


def test_lookup(spark, pages):
    archive = w.write(pages)
    some = pages.where("page_id in (2, 6, 107) or page_id is null").unionAll(pages.where("page_id = 2"))
    found = {(r.record, r.kind): r for r in w.lookup(archive, some).collect()}
    assert found["2", "response"].payload.decode() == "<p>two é 日本</p>" and found["6", "response"].bytes == 300000 and len(found) == 5
    missing = spark.createDataFrame([(77777, "http://a.com/"), (2, "http://other.org/")], "page_id long, url string")
    assert w.lookup(archive, missing).count() == 0


def test_archives_are_plain_warc(pages):
    archive = w.write(pages.where("page_id < 10"))
    files, base = open_folder(archive.folder)
    from pyarrow import fs

    names = [f.path for f in files.get_file_info(fs.FileSelector(base)) if f.path.endswith(".warc.gz")]
    records = []
    for name in names:
        raw = gzip.decompress(files.open_input_file(name).read())
        while raw:
            head = raw.partition(b"\r\n\r\n")[0]
            size = int(next(line.split(b":")[1] for line in head.split(b"\r\n") if line.startswith(b"Content-Length")))
            end = len(head) + 4 + size
            assert raw[end : end + 4] == b"\r\n\r\n"
            records.append(w.parse_record(raw[: end + 4]))
            raw = raw[end + 4 :]
    assert len(records) == 10 and {r["kind"] for r in records} == {"response", "revisit"}


def test_keys():
    assert w.url_key("https://B.a.com:80/x?y") == "com,a,b:80)/x?y" and w.url_key(None) == "-" and w.url_key("http://a.com") == "com,a)/"
    assert " " not in w.url_key("http://a.com/x y\n%") and w.url_key("plain") == "plain"
    assert w.capture_key("http://a.com/", 5) < w.capture_key("http://a.com/", 10)


def test_damage_is_found():
    raw = bytearray(w.record_bytes("http://a.com/", 1, b"payload", None))
    raw[-6] ^= 1
    with pytest.raises(ValueError):
        w.parse_record(bytes(raw))


def test_ids_that_are_text(spark):
    rows = [("None", "u", "a"), ("tab\there", "u", "a"), ("line\r\nWARC-Type: x", "u", "b"), (None, "u", "b"), ("", "u", "c"), ("=%41é", None, None)]
    found = {r.page_id: r for r in w.digest(spark.createDataFrame(rows, "page_id string, url string, html string")).collect()}
    assert set(found) == {r[0] for r in rows}
    assert found["tab\there"].refers_to == "None" and found[None].refers_to == "line\r\nWARC-Type: x" and found[""].record_type == "response"


def test_one_payload_of_many_pages(spark):
    pages = spark.range(0, 5000, 1, 8).selectExpr("id AS page_id", "concat('http://h.org/', id) AS url", "repeat('same ', 50) AS html")
    found = w.digest(pages).groupBy("record_type", "refers_to").count().collect()
    assert {(r.record_type, r.refers_to): r["count"] for r in found} == {("response", None): 1, ("revisit", 0): 4999}
