import base64
import hashlib
import tempfile

import pytest

from stockcast.llm import warc

PAGES = "page_id long, url string, html string, key string, archive string"


def pages(spark, rows):
    return spark.createDataFrame([(*r, "k", "a") for r in rows], PAGES)


def round_trip(spark, rows, **options):
    df, place = pages(spark, rows), tempfile.mkdtemp()
    index = warc.build_index(warc.write_archives(df, place, **options), place)
    return index, warc.read_back(index, df).collect()


def test_url_keys():
    assert warc.url_key("https://www.Example.com:8080/a b?q=1") == "com,example,www:8080)/a%20b?q=1"
    assert warc.url_key("example.org") == "org,example)/"
    assert warc.url_key(None) == warc.url_key("") == ""
    assert "\t" not in warc.url_key("http://x.y/a\tb\nc") and warc.url_key("http://[bad") != ""


def test_record_round_trip():
    body = "héllo\r\n\r\nworld".encode()
    got = warc.parse_record(warc.record(7, "http://a.b/ü", body, None))
    assert got.payload == body and got.headers["WARC-Record-ID"] == "<urn:page:7>"
    seen = warc.parse_record(warc.record(3, None, body, 7))
    assert seen.payload is None and seen.payload_bytes == len(body)
    assert warc.page_of(seen.headers["WARC-Refers-To"]) == 7
    import zlib

    raw = zlib.decompress(warc.record(7, None, body, None), 31).replace(b"world", b"wOrld")
    packer = zlib.compressobj(1, zlib.DEFLATED, 31)
    with pytest.raises(ValueError):
        warc.parse_record(packer.compress(raw) + packer.flush())


def test_pages_come_back(spark, monkeypatch):
    monkeypatch.setattr(warc, "BLOCK_LINES", 3)
    monkeypatch.setattr(warc, "SHARD_LINES", 40)
    rows = [(i, f"http://h{i % 9}.example.com/{i % 13}", f"<p>{i % 50}</p>") for i in range(150)]
    rows += [(200 + i, "http://hot.example.com/", "hot") for i in range(60)] + [(300, None, None), (301, "", ""), (302, "x", None)]
    index, got = round_trip(spark, rows)
    assert len(index.shards) > 3 and len(got) == len(rows)
    best = {}
    for i, _, html in rows:
        best[html or ""] = max(i, best.get(html or "", -1))
    by_page = {r.page_id: r for r in got}
    for i, _, html in rows:
        r, body = by_page[i], (html or "").encode()
        assert r.payload_bytes == len(body)
        assert r.payload_digest == base64.b32encode(hashlib.sha1(body).digest()).decode()
        response = best[html or ""]
        assert (r.record_type, r.refers_to) == (("response", None) if response == i else ("revisit", response))


def test_lookup_of_single_pages(spark):
    rows = [(i, f"http://e.com/{i}", str(i)) for i in range(30)]
    df, place = pages(spark, rows), tempfile.mkdtemp()
    index = warc.build_index(warc.write_archives(df, place), place)
    wanted = spark.createDataFrame([("http://e.com/7", 7), ("http://e.com/7", 8), ("http://none.com/", 1)], "url string, page_id long")
    assert [r.page_id for r in warc.read_back(index, wanted).collect()] == [7]


def test_repeated_and_nameless_pages(spark):
    rows = [(1, "u", "same"), (5, "u", "same"), (5, "u", "same"), (None, "v", "same"), (None, None, "only"), (None, None, "only")]
    got = sorted((r.page_id or 0, r.record_type, r.refers_to) for r in round_trip(spark, rows)[1])
    assert got == [(0, "response", None), (0, "response", None), (0, "revisit", 5), (1, "revisit", 5), (5, "response", None), (5, "response", None)]
    assert all(r.record_type == "response" for r in round_trip(spark, rows, min_bytes=10)[1])


def test_no_pages(spark):
    index, got = round_trip(spark, [])
    assert index.shards == [] and got == []
