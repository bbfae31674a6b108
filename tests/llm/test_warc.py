import base64
import gzip
import hashlib
import uuid

import pytest
from helpers import table
from pyspark.sql import functions as F

from kerbstone.llm import warc
from kerbstone.plans.cut import scratch_root


def captured(spark, rows, **options):
    path = f"{scratch_root(spark)}/{uuid.uuid4().hex}"
    frame = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("payload", F.lit("clash"))
    warc.write_archives(frame, path, **options)
    return warc.assemble(warc.read_archives(spark, path))


ROWS = [
    (5, "https://a.org/x y", "<p>é😀</p>"), (3, "https://a.org/\r\nEvil: 1", "<p>é😀</p>"), (9, None, "<p>é😀</p>"),
    (1, "u", None), (2, "u", ""), (4, "u", "WARC/1.1\r\n\r\nfake"), (6, "u", "x\n" * 50_000),
    (7, "u", "\r\n\r\n"), (8, "u", "\n"), (None, "u", "no id"), (None, "u", "<p>é😀</p>"), (7, "u", "\r\n\r\n"),
]


def test_round_trip(spark):
    rows = captured(spark, ROWS).collect()
    assert len(rows) == len(ROWS)
    for r in rows:
        assert r["request"]["concurrent_to"] == r["metadata"]["concurrent_to"] == r["capture_id"]
        assert "evil" not in r["response"]["headers"]
    texts = sorted(
        bytes(r["response"]["payload"]).decode() for r in rows if r["response"]["type"] == "response")
    assert texts == sorted(["<p>é😀</p>", "", "WARC/1.1\r\n\r\nfake", "x\n" * 50_000, "\r\n\r\n", "\r\n\r\n", "\n", "no id"])


def test_page_columns(spark):
    got = {(r["page_id"], r["record_type"], r["refers_to"]) for r in warc.page_columns(captured(spark, ROWS)).collect()}
    assert got == {
        (5, "revisit", 3), (3, "response", None), (9, "revisit", 3), (1, "response", None), (2, "revisit", 1),
        (4, "response", None), (6, "response", None), (7, "response", None), (8, "response", None),
        (None, "response", None), (None, "revisit", 3),
    }


def test_small_payloads_can_be_left_out_of_revisits(spark):
    got = warc.page_columns(captured(spark, ROWS, revisit_bytes=5)).where("page_id = 2").first()
    assert (got["record_type"], got["refers_to"], got["payload_bytes"]) == ("response", None, 0)


def test_given_table(spark):
    path = f"{scratch_root(spark)}/{uuid.uuid4().hex}"
    pages = table(spark, "pages")
    warc.write_archives(pages, path)
    got = {r["page_id"]: r for r in warc.page_columns(warc.assemble(warc.read_archives(spark, path))).collect()}
    firsts = {}
    rows = sorted((r["page_id"], (r["html"] or "").encode()) for r in pages.collect())
    for page, data in rows:
        first = firsts.setdefault(data, page)
        r = got[page]
        assert r["payload_bytes"] == len(data)
        assert r["payload_digest"] == base64.b32encode(hashlib.sha1(data).digest()).decode()
        assert (r["record_type"], r["refers_to"]) == (("response", None) if first == page else ("revisit", first))


def test_reader_takes_other_archives_and_reports_cut_ones():
    text = warc.record("response", "urn:1", [("X", "y")], "application/http", "HTTP/1.1 200 OK\r\n\r\nbody") + "\n"
    data = gzip.compress(text.encode()) + gzip.compress(text.replace("urn:1", "urn:2").encode())
    assert [(r["record_id"], r["payload"]) for r in warc.read_records(data)] == [("<urn:1>", b"body"), ("<urn:2>", b"body")]
    with pytest.raises(ValueError, match="cut off"):
        list(warc.read_records(text.encode()[:-8]))


def test_empty_table(spark):
    assert captured(spark, []).count() == 0


def test_one_row_per_capture_whatever_names_it(spark):
    fields = warc.RECORD.names

    def row(record_id, kind, to=None):
        return tuple({"record_id": record_id, "type": kind, "concurrent_to": to, "payload_bytes": 1}.get(f) for f in fields)

    records = spark.createDataFrame([
        row("a", "response"), row("q2", "request", "a"), row("q1", "request", "a"), row("m", "metadata", "a"),
        row("m", "metadata", "a"), row("c", "conversion", "a"), row("a", "response"),
        row("b", "revisit"), row("q3", "request", "nowhere"), row("q4", "request"), row(None, "response"),
    ], warc.RECORD)
    got = {r["capture_id"]: r for r in warc.assemble(records).collect()}
    assert got.keys() == {"a", "b"}
    a, b = got["a"], got["b"]
    assert (a["response"]["record_id"], a["request"]["record_id"], a["metadata"]["record_id"]) == ("a", "q1", "m")
    assert [o["record_id"] for o in a["others"]] == ["a", "q2", "m", "c"]
    assert (b["response"]["type"], b["request"], b["metadata"], b["others"]) == ("revisit", None, None, [])
