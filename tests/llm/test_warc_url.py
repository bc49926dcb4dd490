import base64
import hashlib

import pytest
from pyspark.sql import functions as F

from tessera.llm import url_filter, warc
from tessera.session import scratch_path


def pages(spark, rows):
    return spark.createDataFrame([(*r, "x", "y") for r in rows], "page_id bigint, url string, html string, sha256 string, host string")


ROWS = [(5, "http://a.org/fr/x", "same"), (3, "http://b.net/", "same"), (9, None, "same"), (4, "http://x.com", None),
        (7, "http://x.com/\r\ny", ""), (8, "http://u.com", "Ünï" * 50_000), (3, "http://b.net/", "same"), (None, "http://n.net", "same"),
        (None, "http://n.net", "only")]


def test_archive_round_trip(spark):
    folder = scratch_path(spark, "warc-test")
    warc.write_archive(pages(spark, ROWS), folder)
    assert spark.read.parquet(f"{folder}/payloads").count() == 4  # each distinct payload once
    rows = warc.read_archive(spark, folder).collect()
    key = lambda r: (str(r[0]), r[1], r[2])
    got = sorted(((r.page_id, r.record_type, r.refers_to, r.payload_bytes, r.payload_digest, bytes(r.payload)) for r in rows), key=lambda r: (str(r[0]), str(r[2]), r[5]))
    want = []
    for i, _, html in ROWS:
        p = (html or "").encode()
        ids = [a for a, _, h in ROWS if (h or "") == (html or "") and a is not None]
        first = min(ids) if ids else None
        revisit = first is not None and i != first
        want.append((i, "revisit" if revisit else "response", first if revisit else None, len(p),
                     base64.b32encode(hashlib.sha1(p).digest()).decode(), p))
    assert got == sorted(want, key=lambda r: (str(r[0]), str(r[2]), r[5])), key


def test_original_records_and_corruption(spark):
    folder = scratch_path(spark, "warc-test")
    warc.write_archive(pages(spark, ROWS), folder)
    recs = {(r.page_id, bytes(r.record)) for r in warc.original_records(spark, folder).collect()}
    eight = next(b for i, b in recs if i == 8)
    head, http, body = eight.split(b"\r\n\r\n", 2)
    assert head.startswith(b"WARC/1.1\r\nWARC-Type: response\r\n") and body == ("Ünï" * 50_000).encode() + b"\r\n\r\n"
    assert f"Content-Length: {len(http) + 4 + len(body) - 4}".encode() in head
    bad = spark.read.parquet(f"{folder}/payloads").selectExpr("sha256", "payload_bytes", "cast('x' as binary) payload")
    other = scratch_path(spark, "warc-test")
    bad.write.parquet(f"{other}/payloads")
    spark.read.parquet(f"{folder}/headers").write.parquet(f"{other}/headers")
    with pytest.raises(Exception, match="corrupt|different"):
        warc.read_archive(spark, other).collect()


def test_digests_come_from_the_rebuilt_records(spark):
    folder = scratch_path(spark, "warc-test")
    warc.write_archive(pages(spark, ROWS), folder)
    records = warc.original_records(spark, folder)
    cols = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    key = lambda d: sorted((tuple(r) for r in d.select(*cols).collect()), key=repr)
    assert key(warc.digests_of_records(records)) == key(warc.read_archive(spark, folder))
    # one byte more in a record's payload shows
    crlf = F.lit(b"\r\n")
    longer = records.withColumn("record", F.concat(F.substring(F.col("record"), F.lit(1), F.octet_length("record") - 4), F.lit(b"!"), crlf, crlf))
    got = {r.page_id: r.payload_bytes for r in warc.digests_of_records(longer).where("record_type = 'response'").collect()}
    want = {r.page_id: r.payload_bytes + 1 for r in warc.read_archive(spark, folder).where("record_type = 'response'").collect()}
    assert got == want


def test_minimum_payload_and_empty(spark):
    folder = scratch_path(spark, "warc-test")
    warc.write_archive(pages(spark, ROWS), folder, min_bytes=4)
    assert {r.record_type for r in warc.read_archive(spark, folder).collect() if r.payload_bytes < 4} == {"response"}
    empty = scratch_path(spark, "warc-test")
    warc.write_archive(pages(spark, ROWS).limit(0), empty)
    assert warc.read_archive(spark, empty).count() == 0


URLS = [None, "no scheme", "http://", "http://NET/x", "https://a.b.NET?x=/en/", "http://example.net/en/1", "http://xexample.net/en/1",
        "http://www.Example.com/de/#f", "http://example.com/de", "ftp://q.org/fr/://net/", "http://org/fr/", "http://evilnet/", "http://a..net/"]
RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]


def brute(url, rules=RULES, default="allow"):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([rest.find(c) for c in "/?#" if c in rest] + [len(rest)])
        host, rest = "".join(c.lower() if c.isascii() else c for c in rest[:cut]), rest[cut:]
        path = rest[:min([rest.find(c) for c in "?#" if c in rest] + [len(rest)])]
    fits = [(len(h + p), h + p, v) for v, h, p in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=None)
    return host, path, best and best[1], best[2] if best else default


@pytest.mark.parametrize("bound", [1 << 27, 1])
def test_rules_equal_brute_force(spark, monkeypatch, bound):
    monkeypatch.setattr(url_filter, "MAX_LEVEL_BITS", bound)
    df = spark.createDataFrame([(i, u, "k", "r") for i, u in enumerate(URLS)], "page_id bigint, url string, keys string, rule string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_filter.judge_urls(df, RULES).collect()}
    assert got == {i: brute(u) for i, u in enumerate(URLS)}


def test_large_list_is_exact(spark):
    rules = [("block" if i % 3 else "allow", f"h{i}.example.org", "/p/" if i % 2 else "/") for i in range(0, 900, 3)]
    rules += [("block", f"h{i}.example.org", "/") for i in range(1, 900, 3)]
    urls = [f"http://{'s.' * (i % 2)}h{i % 1200}.example.org/{'p/' * (i % 4 == 1)}x" for i in range(3000)]
    df = spark.createDataFrame(list(enumerate(urls)), "page_id bigint, url string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_filter.judge_urls(df, rules).collect()}
    assert got == {i: brute(u, rules) for i, u in enumerate(urls)}


def test_empty_tables(spark):
    df = spark.createDataFrame([], "page_id bigint, url string")
    assert url_filter.judge_urls(df, RULES).count() == 0
    one = spark.createDataFrame([(1, "http://a.net/")], "page_id bigint, url string")
    assert url_filter.judge_urls(one, []).collect()[0].verdict == "allow"


def test_hosts_of_very_many_labels(spark):
    urls = ["http://" + "a." * 50_000 + "net/x", "http://" + "a." * 20_000 + "example.com/de/y", "http://" + "." * 5_000, "http://İ.NET/"]
    df = spark.createDataFrame(list(enumerate(urls)), "page_id bigint, url string")
    rules = [*RULES, ("block", "İ.Net", "/")]
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_filter.judge_urls(df, rules).collect()}
    assert [got[i][2:] for i in range(4)] == [("net/", "block"), ("example.com/de/", "block"), (None, "allow"), ("İ.net/", "block")]
