"""The archive by exact round trips; op12 on the given tables is compared with SQL in test_llm_queries."""

import base64
import hashlib

import pytest

from shelfcast.llm import warc

COLUMNS = "page_id long, url string, html string, address string, bytes int"


def archive(spark, tmp_path, rows, **options):
    folder = str(tmp_path / "archive")
    warc.write_archive(spark.createDataFrame([(*r, "x", 1) for r in rows], COLUMNS).repartition(3), folder, **options)
    return folder


def plain(page_id, url, html, newest):
    """The record as bytes, built without the archive."""
    body = (html or "").encode()
    inline = page_id == newest
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(body)}\r\n\r\n"
    urn = lambda i: f"<urn:x-page:{'' if i is None else i}>"
    lines = [
        "WARC/1.1", f"WARC-Type: {'response' if inline else 'revisit'}", f"WARC-Record-ID: {urn(page_id)}",
        "WARC-Date: 1970-01-01T00:00:00Z", *([f"WARC-Target-URI: {url}"] if url is not None else []),
        f"WARC-Payload-Digest: sha1:{base64.b32encode(hashlib.sha1(body).digest()).decode()}",
        *([] if inline else [f"WARC-Profile: {warc.PROFILE}", f"WARC-Refers-To: {urn(newest)}"]),
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(http) + (len(body) if inline else 0)}", "", http,
    ]
    return "\r\n".join(lines).encode() + (body if inline else b"") + b"\r\n\r\n"


ROWS = [
    (1, "http://a/é", "<p>x\r\n\r\ny</p>"), (2, "http://b", "<p>x\r\n\r\ny</p>"), (5, "http://c", "ü" * 300_000),
    (3, None, None), (4, "http://d", ""), (None, "http://e", "alone"), (None, "http://f", "shared"),
    (9, "http://g", "shared"), (12, "http://h", "twice"), (12, "http://h", "twice"), (11, "http://i", "twice"),
]


def newest_of(rows):
    newest = {}
    for page_id, _, html in rows:
        key = html or ""
        newest[key] = max(newest.get(key, -1), -1 if page_id is None else page_id)
    return {k: None if v < 0 else v for k, v in newest.items()}


def test_records_come_back_byte_by_byte(spark, tmp_path):
    folder = archive(spark, tmp_path, ROWS)
    got = sorted(bytes(r.record) for r in warc.rebuild(spark, folder).collect())
    newest = newest_of(ROWS)
    assert got == sorted(plain(i, u, h, newest[h or ""]) for i, u, h in ROWS)
    assert spark.read.parquet(f"{folder}/payloads").count() == len(newest)


def test_facts_are_read_from_the_archive(spark, tmp_path):
    got = warc.read_archive(spark, archive(spark, tmp_path, ROWS)).collect()
    newest = newest_of(ROWS)
    key = lambda t: tuple(str(x) for x in t)
    want = []
    for page_id, _, html in ROWS:
        body, last = (html or "").encode(), newest[html or ""]
        kind = "response" if page_id == last else "revisit"
        digest = base64.b32encode(hashlib.sha1(body).digest()).decode()
        want.append((page_id, len(body), digest, kind, None if kind == "response" else last))
    assert sorted((tuple(r) for r in got), key=key) == sorted(want, key=key)


def test_small_payloads_are_all_responses(spark, tmp_path):
    got = warc.read_archive(spark, archive(spark, tmp_path, ROWS, min_bytes=7)).collect()
    kinds = {(r.page_id, r.payload_bytes): r.record_type for r in got}
    assert {k for k, v in kinds.items() if v == "revisit"} == {(1, len("<p>x\r\n\r\ny</p>"))}


def test_many_copies_and_line_breaks_in_urls(spark, tmp_path):
    rows = [(i, f"http://x/\r\nWARC-Type: {i}", "copy" if i % 3 else None) for i in range(3_000)]
    got = {r.page_id: r for r in warc.read_archive(spark, archive(spark, tmp_path, rows)).collect()}
    assert {i for i, r in got.items() if r.record_type == "response"} == {2_999, 2_997}
    assert all(got[i].refers_to == (2_999 if i % 3 else 2_997) for i in range(2_997))


def test_no_pages(spark, tmp_path):
    folder = archive(spark, tmp_path, [])
    assert warc.read_archive(spark, folder).collect() == [] == warc.rebuild(spark, folder).collect()


def test_damage_is_found(spark, tmp_path):
    folder = archive(spark, tmp_path, ROWS)
    damaged = spark.read.parquet(f"{folder}/payloads").selectExpr(
        "address", "CASE WHEN bytes = 5 THEN binary('wrong') ELSE payload END AS payload", "newest", "bytes", "sha1"
    )
    damaged.write.parquet(f"{folder}/bad/payloads")
    spark.read.parquet(f"{folder}/records").write.parquet(f"{folder}/bad/records")
    with pytest.raises(Exception, match="another digest"):
        warc.read_archive(spark, f"{folder}/bad").collect()


def test_parse_refuses_other_bytes():
    for bad in (b"", b"no record", b"WARC/1.1\r\nContent-Length: 9\r\n\r\nabc\r\n\r\n"):
        with pytest.raises(warc.ArchiveError):
            warc.parse(bad)
