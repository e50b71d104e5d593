import gzip
import hashlib

import pytest

from martflow.llm import warc

PAGES = [
    (1, "http://a.example/x", "p" * 999),
    (2, "http://a.example/x", "p" * 999),
    (3, "http://b.example/", "é" * 500),
    (5, "http://b.example/", "é" * 500),
    (4, None, "é" * 500),
    (6, "http://c.example/a b\nc", None),
    (7, "", ""),
    (8, "http://d.example/", "line\r\n\r\nWARC/1.1\r\n\r\nfiledesc://x 1 2 3 4\n" * 40),
    (9, "http://e.example/", "\x00퟿" + "long " * 300_000),
]


def brute(rows):
    out = []
    for key, _, text in rows:
        data = (text or "").encode()
        last = max(k for k, _, t in rows if (t or "").encode() == data)
        revisit = len(data) >= 1000 and last != key
        digest = hashlib.sha1(data).hexdigest()
        out.append((key, len(data), digest, "revisit" if revisit else "response", last if revisit else None, True))
    return sorted(out)


@pytest.mark.parametrize("version", [1, 2])
def test_pages_through_both_archives(spark, version):
    pages = spark.createDataFrame(PAGES, "page_id bigint, url string, html string").repartition(2)
    assert sorted(tuple(r) for r in warc.archive(pages, version=version).collect()) == brute(PAGES)


def test_records_say_what_was_in_the_old_archive(spark, tmp_path):
    arc, out = str(tmp_path / "arc"), str(tmp_path / "warc")
    pages = spark.createDataFrame(PAGES, "page_id bigint, url string, html string")
    warc.write_arc(pages, arc, version=2)
    warc.convert(spark, arc, out)
    found = {}
    for f in (tmp_path / "warc").glob("*.gz"):
        for headers, block in warc.read_records(gzip.decompress(f.read_bytes())):
            found[int(warc.http_parts(block)[0]["x-key"])] = headers
    assert sorted(found) == sorted(k for k, *_ in PAGES)
    one, two = found[3], found[5]
    assert (one["warc-type"], two["warc-type"]) == ("revisit", "response")
    assert one["warc-refers-to"] == two["warc-record-id"]
    assert one["warc-date"] == "2024-01-01T00:00:00Z"
    assert one["warc-target-uri"] == "http://b.example/"
    assert warc.untoken(found[6]["warc-target-uri"].encode()) == "http://c.example/a b\nc"


def test_headers_of_both_versions_and_without_a_version_block():
    one = b"http://x/ 1.2.3.4 19970102030405 text/html 5\nhello"
    two = b"http://x/ 1.2.3.4 1997 text/html 200 - - 0 f.arc 5\nhello"
    assert [b for _, b in warc.arc_records(one + b"\n\n" + two)] == [b"hello", b"hello"]
    fields, _ = next(warc.arc_records(warc.version_block(2, b"f") + b"\n" + two))
    assert fields["Result-code"] == b"200" and warc.warc_date(fields["Archive-date"].decode()) == "1997-01-01T00:00:00Z"
    for bad in (one[:-1], b"only three fields\n"):
        with pytest.raises(ValueError):
            list(warc.arc_records(bad))


def test_odd_rows(spark):
    schema = "page_id bigint, url string, html string, key string, value string"
    rows = [(None, None, "x" * 2000, "a", "b"), (3, "u", "y" * 2000, "a", "b"), (3, "u", "y" * 2000, "a", "b")]
    got = sorted((tuple(r)[:1] + tuple(r)[3:5] for r in warc.archive(spark.createDataFrame(rows, schema)).collect()), key=str)
    assert got == [(3, "response", None), (3, "response", None), (None, "response", None)]
    assert warc.archive(spark.createDataFrame([], schema)).count() == 0


def test_a_key_with_two_payloads_revisits_only_with_the_equal_one(spark):
    def seen(rows):
        got = warc.archive(spark.createDataFrame(rows, "page_id bigint, url string, html string"))
        return sorted((r.key, r.payload_digest, r.record_type, r.refers_to) for r in got.collect())

    x, y = ("x" * 2000, "y" * 2000)
    a, b = (hashlib.sha1(t.encode()).hexdigest() for t in (x, y))
    assert seen([(5, "u", x), (5, "u", y), (9, "u", x)]) == sorted([(5, a, "revisit", 9), (5, b, "response", None), (9, a, "response", None)])
    both = [(5, "u", x), (5, "u", y), (9, "u", x), (8, "u", y)]
    assert seen(both) == sorted([(5, a, "revisit", 9), (5, b, "revisit", 8), (9, a, "response", None), (8, b, "response", None)])
