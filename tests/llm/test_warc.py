import gzip
import hashlib

import pytest

from tidecast.llm import warc
from tidecast.llm.warc import archived_pages


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", "y") for r in rows], "page_id long, url string, html string, key string, digest string")


def brute(rows):
    first = {}
    for page, _, html in rows:
        if page is not None and len((html or "").encode()) >= 100:
            first[html] = min(first.get(html, page), page)
    out = []
    for page, _, html in rows:
        data = (html or "").encode()
        again = html in first and first[html] != page
        out.append((page, len(data), hashlib.sha256(data).hexdigest(), "revisit" if again else "response", first[html] if again else None))
    return sorted(out, key=repr)


@pytest.mark.parametrize("parts, block", [(1, 256), (4, 3)])
def test_round_trip(spark, monkeypatch, parts, block):
    monkeypatch.setattr(warc, "BLOCK_CAPTURES", block)
    monkeypatch.setattr(warc, "READ_BYTES", 4000)
    big, small = "é" * 60, "s" * 99
    rows = [(i, f"http://h{i % 4}.example.com/p/{i % 7}?q={i % 2}", big if i % 3 == 0 else f"page {i} " * 20) for i in range(60, 0, -1)]
    rows += [(100, None, None), (101, "no scheme", ""), (102, "http://a.b/\r\nX: y z", small), (103, "HTTP://A.B/", small), (104, "http://a.b", "w" * 3_000_000)]
    rows += [(None, "http://a.b/null", big), (105, "http://a.b/twice", "t" * 200), (105, "http://a.b/twice", "t" * 200)]
    got = archived_pages(frame(spark, rows), parts=parts).collect()
    assert sorted(map(tuple, got), key=repr) == brute(rows)


def test_empty_table(spark):
    assert archived_pages(frame(spark, []).limit(0)).collect() == []


def test_record_holds_its_payload():
    data = "naïve".encode()
    member = warc.record_bytes(7, "http://a/ü", "naïve", hashlib.sha256(data).hexdigest(), len(data), "response", None)
    assert warc.parsed(member)[0] == "7" and warc.parsed(member)[5] == data
    text = gzip.decompress(member)
    assert text.startswith(b"WARC/1.1\r\n") and b"WARC-Target-URI: http://a/%C3%BC\r\n" in text
    broken = gzip.compress(text.replace(data, b"other!"))
    with pytest.raises(ValueError, match="digest"):
        warc.parsed(broken)


def test_lookup_of_some_keys(spark):
    rows = [(i, f"http://x.org/{i}", f"body {i}" * 30) for i in range(50)]
    pages = frame(spark, rows)
    folder = warc.fresh_folder(spark, "test-archives")
    parts = warc.write_archives(warc.captures(pages, "page_id", "url", "html"), folder, 3)
    asked = spark.createDataFrame([("org,x)/7", 7), ("org,x)/7", 7), ("org,x)/nothing", 1), ("org,x)/8", 7), ("org,x)/33", 33)], "key string, id long")
    got = warc.looked_up(asked, parts, folder, pages.schema["page_id"].dataType, payload=True).collect()
    assert sorted((r["id"], bytes(r["payload"]).decode()) for r in got) == [(7, rows[7][2]), (33, rows[33][2])]
