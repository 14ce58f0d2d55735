import base64
import gzip
import hashlib
import os
import random

import pytest

from tidemark.llm import warc


def pages(spark, rows):
    from pyspark.sql import functions as F

    d = spark.createDataFrame(rows, "page_id long, url string, html string")
    for c in ("key", "digest", "off", "file", "refers_to"):
        d = d.withColumn(c, F.lit("clash"))
    return d


def expected(rows, least=0):
    first, out = {}, []
    for i, _, h in sorted((r for r in rows if r[0] is not None), key=lambda r: r[0]):
        b = (h or "").encode()
        f = first.setdefault(b, i)
        ref = f if len(b) >= least and f != i else None
        out.append((i, len(b), base64.b32encode(hashlib.sha1(b).digest()).decode(), "response" if ref is None else "revisit", ref))
    return sorted(out)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(1)
    bodies = ["", None, "same", "x" * 100_000, "ünï\r\n\r\nWARC/1.1", *[f"<p>{k}</p>" for k in range(20)]]
    urls = ["http://a.example.com/x", "https://www.example.org:8080/p?q=1#f", None, "", "not a url\nat all", "HTTP://User@B.example.com", "http://a.example.com/x"]
    return [(k, rng.choice(urls), rng.choice(bodies)) for k in range(300)]


@pytest.mark.parametrize("block", [3000, 7])
def test_round_trip(spark, rows, block):
    got = warc.capture(pages(spark, rows).repartition(3), block=block).collect()
    assert sorted(map(tuple, got)) == expected(rows)


def test_least_size_nulls_repeats_and_empty(spark):
    rows = [(1, "http://a/", "aa"), (2, "http://a/", "aa"), (3, "http://b/", "long one"), (4, "http://c/", "long one")]
    assert sorted(map(tuple, warc.capture(pages(spark, rows), least=4).collect())) == expected(rows, 4)
    got = warc.capture(pages(spark, [(None, "http://a/", "q"), (5, "http://a/", "q"), (5, "http://z/", "q")])).collect()
    assert sorted((str(r["page_id"]), r["record_type"], r["refers_to"]) for r in got) == [("5", "response", None), ("5", "response", None), ("None", "response", None)]
    assert warc.capture(pages(spark, []).limit(0)).count() == 0


def test_index_has_two_levels(spark, rows, tmp_path):
    folder = str(tmp_path / "w")
    rec = warc.write_archives(pages(spark, rows), folder)
    directory = warc.write_index(rec, folder, 10)
    d = [tuple(r) for r in directory.collect()]
    assert sum(r[5] for r in d) == len(rows) and max(r[5] for r in d) <= 10
    reader = warc.Reader(folder, d)
    want = (warc.key_of("http://a.example.com/x"), [i for i, u, _ in rows if u == "http://a.example.com/x"])
    for i in want[1]:
        (place,) = reader.find(want[0], warc.sort_id(i))
        fields, _, _ = reader.record(*place)
        assert fields["WARC-Record-ID"] == f"<urn:page:{i}>"
    assert reader.find(want[0], warc.sort_id(10**6)) == []
    # archives are plain gzip members that any reader can take in order
    raw = b"".join(gzip.decompress(open(f"{folder}/{f}", "rb").read()) for f in sorted({r["file"] for r in rec.select("file").distinct().collect()}))
    assert raw.count(b"WARC-Record-ID") == len(rows) and os.path.isdir(folder)


def test_keys():
    assert warc.key_of("http://User@Www.Example.com:80/A?b=1#c") == "com,example,www)/A?b=1"
    assert warc.key_of("https://x.org:8443") == "org,x:8443)/"
    assert warc.key_of("urn:page:4") == "urn:page:4"
    assert warc.sort_id(None) < warc.sort_id(-5) < warc.sort_id(3) < warc.sort_id(20)


def test_rows_of_one_id_are_judged_by_their_own_payloads(spark):
    rows = [(1, "http://a.b/1", "AAA"), (5, "http://a.b/5", "AAA"), (5, "http://a.b/5", "UNIQUE"), (5, "http://a.b/5", "BBB"), (3, "http://a.b/3", "BBB"), (None, None, "AAA"), (7, None, None), (8, None, "")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = sorted((str(r["page_id"]), r["payload_digest"], r["record_type"], r["refers_to"]) for r in warc.capture(pages).collect())
    d = lambda t: warc.digest(t.encode())
    assert got == sorted([
        ("1", d("AAA"), "response", None), ("5", d("AAA"), "revisit", 1), ("5", d("UNIQUE"), "response", None), ("5", d("BBB"), "revisit", 3),
        ("3", d("BBB"), "response", None), ("None", d("AAA"), "response", None), ("7", d(""), "response", None), ("8", d(""), "revisit", 7),
    ])
