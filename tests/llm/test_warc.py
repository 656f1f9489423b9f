import gzip
import hashlib
import base64
import io

from drydock.llm import warc
from drydock.session import scratch

PAGES = "page_id long, url string, html string, size string, digest string"


def test_members_and_records():
    digest = warc.digest_of(b"abc")
    assert digest == base64.b32encode(hashlib.sha1(b"abc").digest()).decode()
    one = warc.record_bytes(7, "http://a/\r\nx: y", b"abc", digest, False, None, "2024-01-01T00:00:00Z")
    two = warc.record_bytes(8, None, b"abc", digest, True, 7, "2024-01-01T00:00:00Z")
    assert gzip.decompress(one).startswith(b"WARC/1.1\r\n")
    found = list(warc.members(io.BytesIO(one + two)))
    assert [(o, e) for o, _, e in found] == [(0, None), (len(one), None)]
    first, second = (warc.read_record(c) for _, c, _ in found)
    assert (first["page_id"], first["warc_type"], first["payload"], first["error"]) == (7, "response", b"abc", None)
    assert (second["refers_to"], second["payload_bytes"], second["payload_digest"], second["payload"]) == (7, 3, digest, None)


def test_faults():
    digest = warc.digest_of(b"abc")
    one = warc.record_bytes(1, "u", b"abc", digest, False, None, "d")
    assert list(warc.members(io.BytesIO(one[:-9])))[0][2] == "archive ends inside a member"
    assert "bad gzip" in list(warc.members(io.BytesIO(one + b"junk")))[1][2]
    content = gzip.decompress(one)
    assert warc.read_record(content.replace(b"abc", b"abd"))["error"] == "block digest differs"
    assert "Content-Length" in warc.read_record(content[:-6] + b"\r\n\r\n")["error"]
    assert warc.read_record(b"nothing")["error"] == "no WARC header"
    lying = warc.record_bytes(1, "u", b"abc", warc.digest_of(b"x"), False, None, "d")
    assert warc.read_record(gzip.decompress(lying))["error"] == "payload digest differs"


def test_one_read_at_a_time():
    class Drip(io.BytesIO):
        def read(self, n=-1):
            return super().read(3)
    data = b"".join(warc.record_bytes(k, None, b"p" * k, warc.digest_of(b"p" * k), False, None, "d") for k in range(4))
    assert [len(warc.read_record(c)["payload"]) for _, c, _ in warc.members(Drip(data))] == [0, 1, 2, 3]


def test_round_trip(spark):
    rows = [(1, "u", "<p>é</p>", "a", "b"), (2, None, "<p>é</p>", None, None), (3, "v", None, "", ""), (4, "v", "", "", ""),
            (5, "w", "x" * 300_000, "", ""), (5, "w", "x" * 300_000, "", ""), (6, "w", "y", "", ""), (None, None, "y", None, None),
            (None, None, "z", None, None), (-7, "n", "only", "", "")]
    pages = spark.createDataFrame(rows, PAGES)
    found = sorted(map(repr, (tuple(r) for r in warc.round_trip(spark, pages).select(
        "page_id", "warc_type", "refers_to", "payload_bytes", "payload_digest", "error").collect())))
    def told(page, kind, to, html):
        body = (html or "").encode()
        return repr((page, kind, to, len(body), warc.digest_of(body), None))
    assert found == sorted([
        told(1, "revisit", 2, "<p>é</p>"), told(2, "response", None, "<p>é</p>"), told(3, "revisit", 4, ""),
        told(4, "response", None, ""), told(5, "response", None, rows[4][2]), told(5, "response", None, rows[4][2]),
        told(6, "response", None, "y"), told(None, "revisit", 6, "y"), told(None, "response", None, "z"),
        told(-7, "response", None, "only")])
    assert warc.round_trip(spark, pages.limit(0)).collect() == []


def test_payloads_and_rolling(spark):
    pages = spark.createDataFrame([(k, f"u{k}", f"<p>{k}</p>", "", "") for k in range(40)], PAGES)
    archives = warc.write_archives(pages.coalesce(1), scratch(spark, "warc-test"), roll=600)
    listed = archives.collect()
    assert len(listed) > 3 and sum(r["n_records"] for r in listed) == 40
    found = {r["page_id"]: (r["target_uri"], bytes(r["payload"])) for r in warc.read_archives(archives).collect()}
    assert found == {k: (f"u{k}", f"<p>{k}</p>".encode()) for k in range(40)}


def test_small_payloads_stay_responses(spark):
    pages = spark.createDataFrame([(1, "u", "ab", "", ""), (2, "u", "ab", "", "")], PAGES)
    kinds = [r["warc_type"] for r in warc.round_trip(spark, pages, least_bytes=3).collect()]
    assert kinds == ["response", "response"]
