import base64
import gzip
import hashlib

import pytest

from patronage.llm import warc
from patronage.session import scratch_path

SCHEMA = "page_id long, url string, html string"
ROWS = [
    (3, "http://a/x", "abc\r\n\r\nWARC/1.1\r\nContent-Length: 5\r\n\r\n"),
    (2, "http://b", "abc\r\n\r\nWARC/1.1\r\nContent-Length: 5\r\n\r\n"),
    (4, None, None),
    (5, "bad\r\nurl: x ", ""),
    (6, "http://é.fr/ü?q", "é" * 100_000),
    (6, "http://é.fr/ü?q", "é" * 100_000),
    (None, "u", "zz"),
    (None, "v", "zz"),
    (9, "http://[x", "q"),
    (10, "", "\x00\x1f binary �"),
    (11, "w", "zz"),
    (12, "same id", "twice"),
    (12, "another", "twice"),
    *[(13, "often", "equal")] * 7,
    *[(14, "later", "equal")] * 2,
]


def digest(html):
    return base64.b32encode(hashlib.sha1((html or "").encode()).digest()).decode()


def expected(rows):
    order = lambda r: tuple((x is None, x or 0) if i == 0 else (x is None, x or "") for i, x in enumerate(r[:2]))
    first = {}
    for r in rows:
        first[r[2] or ""] = min(first.get(r[2] or "", r), r, key=order)
    out, given = [], set()
    for page_id, url, html in rows:
        of = first[html or ""]
        own = (page_id, url) == of[:2] and of not in given
        given |= {of} if own else set()
        kind, refers = ("response", None) if own else ("revisit", of[0])
        out.append((page_id, len((html or "").encode()), digest(html), kind, refers))
    return sorted(out, key=repr)


@pytest.mark.parametrize("compression", ["gzip", "none"])
def test_round_trip(spark, clashing, compression, monkeypatch):
    monkeypatch.setattr(warc, "COPIES", 3)
    path = scratch_path(spark, "test")
    warc.write(clashing(spark.createDataFrame(ROWS, SCHEMA)), path, compression, file_records=5)
    found = warc.captures(warc.read(spark, path))
    assert sorted(map(tuple, warc.pages(found).collect()), key=repr) == expected(ROWS)
    for r in found.collect():
        assert r["request"]["kind"] == "request" and r["request"]["concurrent_to"] == [r["record_id"]]
        assert r["metadata"]["concurrent_to"] == [r["record_id"]]
        if r["main"]["kind"] == "response":
            page = r["metadata"]["fields"].get("page-id")
            html = next(h for p, _, h in ROWS if (None if p is None else str(p)) == page and (page or h == "zz"))
            assert bytes(r["main"]["payload"]) == (html or "").encode()
            assert r["main"]["found_digest"] == r["main"]["payload_digest"]


def test_query_against_sql(spark, tmp_path):
    """Repeated rows and page_ids, by the registered query and its SQL."""
    import duckdb

    from patronage.llm.queries import op8

    rows = [r for r in ROWS if r[0] is not None]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/pages.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet/*.parquet'")
    assert sorted(map(tuple, op8.query(spark, str(tmp_path)).collect()), key=repr) == sorted(con.execute(op8.SQL).fetchall(), key=repr)


def test_empty_table(spark):
    path = scratch_path(spark, "test")
    warc.write(spark.createDataFrame([], SCHEMA), path)
    assert warc.pages(warc.captures(warc.read(spark, path))).count() == 0


def test_archives_of_others(spark, tmp_path):
    """Members gzipped one by one, a record without partners, several of a kind, case of header names."""

    def record(kind, name, block, *more):
        head = [f"WARC-Type: {kind}", f"warc-record-id: <{name}>", *more, f"content-length: {len(block)}"]
        return "\r\n".join(["WARC/1.0", *head, "", ""]).encode() + block + b"\r\n\r\n"

    http = "Content-Type: application/http;msgtype=response"
    records = [
        record("warcinfo", "i", b"software: x"),
        record("response", "r1", b"HTTP/1.1 200 OK\r\n\r\nbody\r\n\r\nmore", http),
        record("request", "q2", b"GET /2", "WARC-Concurrent-To: <r1>"),
        record("request", "q1", b"GET /1", "WARC-Concurrent-To: <r1>", "WARC-Concurrent-To: <r2>"),
        record("response", "r2", b"HTTP/1.1 404 No\r\n\r\n", http),
        record("response", "r3", b"HTTP/1.1 200 OK", http),
    ]
    (tmp_path / "a.warc.gz").write_bytes(b"".join(map(gzip.compress, records)))
    (tmp_path / "b.warc").write_bytes(records[1].replace(b"<r1>", b"<r9>"))
    found = {r["record_id"]: r for r in warc.captures(warc.read(spark, f"file://{tmp_path}")).collect()}
    assert sorted(found) == ["<r1>", "<r2>", "<r3>", "<r9>"]
    assert bytes(found["<r1>"]["main"]["payload"]) == b"body\r\n\r\nmore"
    assert found["<r1>"]["request"]["record_id"] == found["<r2>"]["request"]["record_id"] == "<q1>"
    assert found["<r3>"]["request"] is None and found["<r3>"]["metadata"] is None
    with pytest.raises(ValueError, match="cut off"):
        list(warc.parse_records(records[1][:-8], True))
