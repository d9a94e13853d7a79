from __future__ import annotations

import gzip
import io

import pytest

from modelyard.llm import warc

ROWS = [
    (1, "http://a.example/", "<p>one</p>"), (2, "http://a.example/2", "<p>one</p>"), (3, None, None), (4, "x y\r\nz", ""),
    (9, "http://ü.example/", "é" * 10), (None, "http://n.example", "alone"), (5, "u", "WARC/1.1\r\n\r\n" * 3),
    (6, "u", "y" * 3_000_000), (7, "u", "same"), (7, "u", "same"), (8, "u", "same"),
]


def frame(spark, rows):
    return spark.createDataFrame([(*r, "extra", 1) for r in rows],
                                 "page_id long, url string, html string, digest string, response int")


def plain(rows, least=0):
    best, count = {}, {}
    for k, _, body in rows:
        body = (body or "").encode()
        count[body] = count.get(body, 0) + 1
        if k is not None:
            best[body] = max(best.get(body, k), k)
    out = []
    for k, _, body in rows:
        body = (body or "").encode()
        repeat = count[body] > 1 and len(body) >= least and k != best[body]
        out.append((k, len(body), warc.digest32(body), "revisit" if repeat else "response", best[body] if repeat else None))
    return sorted(out, key=repr)


def back(spark, rows, **named):
    folder, manifest = warc.write_archives(frame(spark, rows), **named)
    return warc.read_archives(folder, manifest, 2).collect()


@pytest.mark.parametrize("least", [0, 5])
def test_round_trip(spark, least):
    got = back(spark, ROWS, least=least)
    assert sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got), key=repr) \
        == plain(ROWS, least)
    bodies = {r.payload_digest: bytes(r.payload) for r in got if r.record_type == "response"}
    assert all(warc.digest32(b) == d for d, b in bodies.items())
    urls = {r.page_id: r.url for r in got}
    assert urls[9] == "http://ü.example/" and urls[3] is None and urls[4] == "x%20y%0D%0Az"


def test_archives_close_at_their_size(spark):
    folder, manifest = warc.write_archives(frame(spark, [(i, "u", str(i) * 50) for i in range(60)]), archive_bytes=2000)
    assert manifest.count() > 4
    assert manifest.groupBy().sum("records").first()[0] == 60 == warc.read_archives(folder, manifest).count()


def test_empty_table(spark):
    assert back(spark, []) == []


def archive(*records):
    return b"".join(records)


def test_members_are_plain_gzip_and_errors_are_found():
    one, two = warc.record(1, "u", b"abc", None, False), warc.record(2, "u", b"abc", 3, True)
    text = gzip.decompress(archive(one, two))
    assert text.count(b"WARC/1.1\r\n") == 2 and b"WARC-Refers-To: <urn:page:3:" in text
    assert [f["warc-type"] for f, _ in warc.read_records(io.BytesIO(archive(one, two)))] == ["response", "revisit"]
    spoiled = gzip.compress(gzip.decompress(one).replace(b"abc", b"abd"))
    for bad in (spoiled, one[:-12], gzip.compress(b"nothing"), gzip.compress(gzip.decompress(one) + b"more")):
        with pytest.raises((ValueError, Exception)):
            list(warc.read_records(io.BytesIO(bad)))
