"""Archives read back through the capture index."""

import base64
import gzip
import hashlib

from odflux.llm import warc

SCHEMA = "page_id long, url string, html string, key string, sha1 string"


def expected(rows):
    least = {}
    for page, _, html, *_ in rows:
        own = least.setdefault(html or "", page)
        least[html or ""] = page if own is None else own if page is None else min(own, page)
    out = []
    for page, _, html, *_ in rows:
        raw, first = (html or "").encode(), least[html or ""]
        out.append((page, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(),
                    "response" if page == first else "revisit", None if page == first else first))
    return sorted(out, key=repr)


def test_edges_round_trip(spark, monkeypatch):
    monkeypatch.setattr(warc, "LOOKUPS_A_TASK", 10)
    rows = [(i, f"http://h{i % 7}.example.com/p{i}?q=ü {i}", f"<p>{i % 40}</p>", "k", "s") for i in range(300)]
    rows += [(1_000 + i, "https://Hot.example.org:8080/", "same page", None, None) for i in range(150)]
    rows += [(None, "http://a.b/", "x", "", ""), (2_000, None, None, "", ""), (2_001, "", "", "", ""), (2_002, "no host", "x", "", ""),
             (2_003, "http://u@c.d/\r\nInjected: 1", "a\r\n\r\nb\0é" * 5, "", ""), (2_004, "http://c.d/", "long " * 400_000, "", ""),
             (5, rows[5][1], rows[5][2], "", ""), (5, rows[5][1], rows[5][2], "", "")]
    got = warc.archive_and_read_back(spark.createDataFrame(rows, SCHEMA))
    fields = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    assert sorted((tuple(r) for r in got.select(fields).collect()), key=repr) == expected(rows)


def test_empty_table(spark):
    assert warc.archive_and_read_back(spark.createDataFrame([], SCHEMA)).count() == 0


def test_lookup_gives_payloads_and_nothing_for_unknown_keys(spark):
    pages = spark.createDataFrame([(1, "http://a.b/x#y", "one", "", ""), (2, "http://a.b/x", "two", "", "")], SCHEMA)
    folder = warc.new_folder(spark)
    directory = warc.build_index(warc.write_archives(pages, folder), folder)
    wanted = spark.createDataFrame([("b,a)/x", 1), ("b,a)/x", 2), ("b,a)/x", 3), ("zz", 1)], "key string, page_id long")
    got = {(r.page_id, r.url, bytes(r.payload)) for r in warc.look_up(wanted, folder, directory).collect()}
    assert got == {(1, "http://a.b/x#y", b"one"), (2, "http://a.b/x", b"two")}


def test_keys(spark):
    urls = ["http://www.Example.com:80/A?b=1#c", "https://u:p@x.y", "mailto:me", None, "http://h/a\nb"]
    frame = spark.createDataFrame([(u,) for u in urls], "url string")
    assert [r[0] for r in frame.select(warc.reversed_host_key("url")).collect()] == [
        "com,example,www)/A?b=1", "y,x)", "mailto:me", "", "h)/a\nb"]


def test_record_is_a_readable_member():
    raw = gzip.compress(warc.record(7, "http://a/ b", b"body", b"\0" * 20, 3, "2024-01-01T00:00:00Z"))
    headers, payload, told = warc.parse_record(gzip.decompress(raw))
    assert (headers["WARC-Type"], headers["WARC-Refers-To"], payload, told) == ("revisit", "<urn:x-page:3>", b"", 4)
