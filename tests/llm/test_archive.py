import base64
import hashlib

import pytest

from cohortweave.llm import archive
from cohortweave.llm.queries import QUERIES

SCHEMA = "page_id long, url string, html string, digest string, address string, key string, record_type string"


def frame(spark, rows):
    return spark.createDataFrame([(i, u, h, "x", "y", "z", "w") for i, u, h in rows], SCHEMA)


def told(df):
    return sorted((r.key or "", r.record_type, r.payload_bytes, r.payload_digest, r.refers_to or "") for r in df.collect())


def by_hand(rows, min_bytes=0):
    first = {}
    for i, _, h in rows:
        b = (h or "").encode()
        if i is not None:
            first[b] = min(first.get(b, i), i)
    out = []
    for i, _, h in rows:
        b = (h or "").encode()
        digest = base64.b32encode(hashlib.sha1(b).digest()).decode()
        again = len(b) >= min_bytes and b in first and first[b] != i
        out.append(("" if i is None else str(i), "revisit" if again else "response", len(b), digest, str(first[b]) if again else ""))
    return sorted(out)


ROWS = [
    (3, "http://a/", "<p>same</p>"),
    (1, "http://b/?q=\r\nX: y", "<p>same</p>"),
    (2, None, "<p>same</p>"),
    (2, None, "<p>same</p>"),
    (1, "http://b/", "<p>same</p>"),
    (4, "http://c/", None),
    (5, "http://d/", ""),
    (10, "http://e/", "\r\n\r\nWARC/1.1\r\n\r\n\x00é\U0001f600"),
    (9, "http://e/", "\r\n\r\nWARC/1.1\r\n\r\n\x00é\U0001f600"),
    (None, "http://f/", "<p>same</p>"),
    (None, "http://g/", "only without a key"),
    (-7, "http://h/", "ab " * 3_500_000),
    (8, "http://h/", "ab " * 3_500_000),
]


@pytest.mark.parametrize("min_bytes", [0, 1, 12])
def test_as_by_hand(spark, min_bytes):
    assert told(archive.archived(frame(spark, ROWS), min_bytes=min_bytes)) == by_hand(ROWS, min_bytes)


def test_a_payload_is_stored_once_and_records_are_exact(spark):
    made = archive.write_archive(frame(spark, ROWS))
    assert spark.read.parquet(made.payloads).count() == len({(h or "") for _, _, h in ROWS})
    records = {bytes(r.record) for r in archive.reconstruct(spark, made).collect()}
    html = b"\r\n\r\nWARC/1.1\r\n\r\n\x00" + "é\U0001f600".encode()
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(html)
    digest = base64.b32encode(hashlib.sha1(html).digest())
    head = (
        b"WARC/1.1\r\nWARC-Type: %s\r\nWARC-Record-ID: <urn:record:%s>\r\nWARC-Date: 1970-01-01T00:00:00Z\r\n"
        b"WARC-Target-URI: http://e/\r\nWARC-Payload-Digest: sha1:" + digest + b"\r\n%s"
        b"Content-Type: application/http; msgtype=response\r\nContent-Length: %d\r\n\r\n"
    )
    refers = b"WARC-Refers-To: <urn:record:9>\r\nWARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest\r\n"
    assert head % (b"response", b"9", b"", len(http + html)) + http + html + b"\r\n\r\n" in records
    assert head % (b"revisit", b"10", refers, len(http)) + http + b"\r\n\r\n" in records


def test_a_damaged_payload_stops_the_job(spark):
    made = archive.write_archive(frame(spark, ROWS[:6]))
    other = spark.read.parquet(made.payloads).selectExpr("address", "first_key", "cast('forged' AS binary) AS payload")
    other.write.parquet(made.payloads + "-other")
    with pytest.raises(Exception, match="Damaged payload"):
        archive.reconstruct(spark, archive.Archive(made.payloads + "-other", made.records)).collect()
    other.limit(0).write.parquet(made.payloads + "-none")
    with pytest.raises(Exception, match="No payload"):
        archive.reconstruct(spark, archive.Archive(made.payloads + "-none", made.records)).collect()


def test_parse_of_other_records(spark):
    cases = {
        "none": None,
        "no_gap": b"WARC/1.1\r\nWARC-Type: response",
        "short": b"WARC/1.1\r\ncontent-length: 99\r\n\r\nHTTP/1.1 200 OK\r\n\r\nbody",
        "no_http": b"WARC/1.1\r\nWARC-Type: warcinfo\r\nContent-Length: 4\r\n\r\nbody\r\n\r\n",
        "no_size": b"WARC/1.1\r\nWARC-Type: response\r\nContent-Length: many\r\n\r\nbody\r\n\r\n",
        "twice": b"WARC/1.1\r\nX: 1\r\nX: 2\r\n\xff: \xff\r\nContent-Length: 8\r\n\r\nH\r\n\r\n\xff\x00\r\n\r\n\r\n",
    }
    rows = spark.createDataFrame([(k, v, 1) for k, v in cases.items()], "fields_of string, record binary, _size int")
    found = {r.fields_of: r for r in archive.parse(rows).collect()}
    assert found["none"].fields is None and found["no_gap"].fields is None
    assert all(found[k].payload is None and found[k].fields for k in ("short", "no_http", "no_size"))
    assert found["twice"].http_head == "H" and bytes(found["twice"].payload) == b"\xff\x00\r"
    assert [x.value for x in found["twice"].fields[:2]] == ["1", "2"]
    assert {"fields_of", "record", "_size", "fields", "http_head", "payload"} == set(archive.parse(rows).columns)


def test_empty_table_and_query(spark, tmp_path):
    empty = frame(spark, ROWS).limit(0)
    assert archive.archived(empty).collect() == []
    frame(spark, ROWS[:9]).select("page_id", "url", "html").write.parquet(f"{tmp_path}/pages.parquet")
    got = QUERIES["op11_web_archive"](spark, str(tmp_path))
    assert got.columns == ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    assert sorted((str(r[0]), r[3], r[1], r[2], str(r[4] or "")) for r in got.collect()) == by_hand(ROWS[:9])
