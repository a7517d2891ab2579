"""WARC archives: whole round trip, records, lookups through both levels of the index."""

import gzip
import hashlib
from collections import Counter
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from marketlake.llm import warc

SCHEMA = "page_id long, url string, html string, key string, row int, file string"


def table(spark, pages):
    return spark.createDataFrame([(*p, "clash", 1, None) for p in pages], SCHEMA)


def expected(pages):
    first = {}
    for i, _, html in pages:
        payload = (html or "").encode()
        order = (i is None, i or 0)
        if len(payload) >= 100 and (payload not in first or order < first[payload]):
            first[payload] = order
    done, out = set(), []
    for i, _, html in sorted(pages, key=lambda p: (p[0] is None, p[0] or 0)):
        payload = (html or "").encode()
        again = payload in done
        if len(payload) >= 100:
            done.add(payload)
        to = first[payload] if again else None
        out.append((i, len(payload), hashlib.sha256(payload).hexdigest(), "revisit" if again else "response", to[1] if to and not to[0] else None))
    return sorted(out, key=repr)


PAGES = [
    (1, "http://www.Example.com/a?x=1#top", "<p>" + "é東🙂" * 40), (2, "https://user@www.example.com:443/a?x=1", "<p>" + "é東🙂" * 40),
    (3, None, None), (4, "", ""), (5, "http://example.com:8080", "x" * 99), (6, "http://example.com:8080/", "x" * 99),
    (7, "http://[bad/", "y" * 100), (8, "mailto:a@b", "y" * 100), (9, "http://1.2.3.4/\r\nX: y", "\r\n\r\n" * 300), (None, "http://a.b/", "y" * 100),
    (10, "http://a.b/", "long " * 400_000), (11, "http://a.b/", "long " * 400_000), (11, "http://a.b/", "long " * 400_000), (12, "http://a.b/ü ö%20", "\x00" * 200),
    (None, None, "z" * 500), (None, None, "z" * 500),
]


def test_round_trip(spark, rows):
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    assert rows(warc.round_trip(table(spark, PAGES)), *columns) == expected(PAGES)
    assert warc.round_trip(table(spark, [])).count() == 0


def test_hot_key_and_payload_over_many_blocks(spark, rows, monkeypatch):
    monkeypatch.setattr(warc.build_index, "__defaults__", (16, 50))
    monkeypatch.setattr(warc.write_archives, "__defaults__", ("2020-02-03T04:05:06Z", 4000))
    hot = [(i, "http://hot.example.org/page", "same " * 30 if i % 3 else f"own {i} " * 20) for i in range(400)]
    pages = hot + [(1000 + i, f"http://h{i % 7}.example.org/{i}", f"page {i} " * 15) for i in range(300)]
    df = table(spark, pages).repartition(5)
    assert rows(warc.round_trip(df), "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to") == expected(pages)
    folder, captures = warc.write_archives(df)
    index = warc.build_index(folder, captures)
    assert len(index.files) > 5 and captures.select("file").distinct().count() > 5
    asked = spark.createDataFrame([("http://HOT.example.org/page",), ("http://hot.example.org/page#x",), ("http://h3.example.org/3",), ("http://none.org/",), ("http://a.org",)], "url string")
    found = Counter(r["key"] for r in warc.lookup(index, asked).collect())
    assert found == {"org,example,hot)/page": 400, "org,example,h3)/3": 1}


def test_archives_are_readable_gzip_members(spark):
    folder, captures = warc.write_archives(table(spark, PAGES))
    for capture in captures.collect():
        data = (Path(folder.removeprefix("file:")) / capture["file"]).read_bytes()
        whole = gzip.decompress(data)
        assert whole.startswith(b"WARC/1.1\r\nWARC-Type: warcinfo")
        headers, payload = warc.parse_record(data[capture["offset"] : capture["offset"] + capture["length"]])
        assert headers["warc-type"] == capture["record_type"]
        assert capture["record_type"] == "revisit" or payload.decode() == (dict((i, h) for i, _, h in PAGES)[capture["page_id"]] or "") or capture["page_id"] is None
    with pytest.raises(ValueError):
        warc.parse_record(gzip.compress(b"WARC/1.1\r\nContent-Length: 9\r\n\r\nshort\r\n\r\n"))


def test_keys():
    keys = {
        "http://www.Example.com/a?x=1#top": "com,example,www)/a?x=1", "https://u:p@a.b:443": "b,a)/", "http://a.b:8080/x": "b,a:8080)/x",
        "http://1.2.3.4/": "1.2.3.4)/", "http://[::1]/": "::1)/", "no url": "no url", "": "", "http://a.b:99999/": "http://a.b:99999/",
    }
    assert {u: warc.url_key(u) for u in keys} == keys and warc.url_key(None) == ""


def test_missing_rows_are_not_found(spark):
    folder, captures = warc.write_archives(table(spark, PAGES))
    index = warc.build_index(folder, captures.where(F.lit(False)))
    assert index.files == [] and warc.lookup(index, table(spark, PAGES)).count() == 0
