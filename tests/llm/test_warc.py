from __future__ import annotations

import base64
import gzip
import hashlib

import pytest

from ringledger.llm.warc import (
    deduplicate,
    deduplicated_pages,
    parse,
    read_archives,
    write_pages,
)

PAGES = [
    (1, "http://a/1", "<p>same</p>"),
    (2, "http://a/2", "<p>same</p>"),
    (3, "http://a/3", "ends\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\n\r\n"),
    (9, "http://a/9", None),
    (4, None, ""),
    (5, "http://a/b c\r\nX: y", "é \x00\n"),
    (None, "http://a/n", "<p>same</p>"),
    (7, "http://a/7", "twice"),
    (7, "http://a/7", "twice"),
    (8, "http://a/8", "long " * 300_000),
]


@pytest.fixture
def pages(spark):
    return spark.createDataFrame(PAGES, "page_id long, url string, html string")


def test_payloads_round_trip(spark, pages):
    rows = read_archives(spark, write_pages(pages), payloads=True).collect()
    assert sorted((str(r["page_id"]), r["payload"]) for r in rows) == sorted(
        (str(i), html or "") for i, _, html in PAGES
    )
    assert {r["url"] for r in rows if r["page_id"] == 5} == {"http://a/b%20c%20%20X:%20y"}


def test_revisits_by_brute_force(pages):
    found = [r.asDict() for r in deduplicated_pages(pages).collect()]
    assert len(found) == len(PAGES)
    for row in found:
        html = next(h or "" for i, _, h in PAGES if i == row["page_id"]).encode()
        assert row["payload_bytes"] == len(html)
        assert row["payload_digest"] == base64.b32encode(hashlib.sha1(html).digest()).decode()
    by_page = {(r["page_id"], r["record_type"], r["refers_to"]) for r in found}
    assert by_page == {
        (1, "revisit", 2), (2, "response", None), (None, "revisit", 2), (3, "response", None),
        (9, "response", None), (4, "revisit", 9), (5, "response", None), (8, "response", None),
        (7, "revisit", 7), (7, "response", None),
    }


def test_smaller_payloads_stay_responses(pages):
    rows = deduplicated_pages(pages, min_bytes=8).collect()
    assert {r["page_id"] for r in rows if r["record_type"] == "revisit"} == {1, None}


def test_deduplicated_archives_hold_each_payload_once(spark, pages):
    rows = read_archives(spark, deduplicate(spark, write_pages(pages)), payloads=True).collect()
    texts = [r["payload"] for r in rows if r["record_type"] == "response"]
    assert sorted(texts) == sorted({html or "" for _, _, html in PAGES})
    ids = {r["record_id"]: r for r in rows if r["record_type"] == "response"}
    for r in rows:
        if r["record_type"] == "revisit":
            assert ids[r["refers_to_id"]]["payload_digest"] == r["payload_digest"]


def test_parse_reads_several_gzip_members():
    head = b"WARC/1.1\r\nWARC-Type: response\r\nContent-Length: %d\r\n\r\n"
    block = b"HTTP/1.1 200 OK\r\n\r\nbody"
    record = head % len(block) + block + b"\r\n\r\n"
    content = gzip.compress(record) + gzip.compress(record * 2)
    assert [payload for _, payload in parse(content)] == [b"body"] * 3


def test_empty_table(pages):
    assert deduplicated_pages(pages.limit(0)).collect() == []
