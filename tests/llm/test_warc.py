from __future__ import annotations

import base64
import hashlib

import pytest
from pyspark.sql import functions as F

from demandlab.llm import warc
from demandlab.session import scratch_path

PAGES = "page_id long, url string, html string, source string"


def by_hand(rows):
    first = {}
    for page, _, html in rows:
        key = html or ""
        if page is not None and (first.get(key) is None or page < first[key]):
            first[key] = page
        first.setdefault(key, None)
    out = []
    for page, _, html in rows:
        data, one = (html or "").encode(), first[html or ""]
        same = one is None or one == page
        out.append((page, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(),
                    "response" if same else "revisit", None if same else one))
    return sorted(out, key=repr)


def test_round_trip(spark):
    rows = [(7, "http://www.A.example/x?q=1", "é<p>one</p>"), (3, "http://b.example:8080/", "é<p>one</p>"), (4, None, None),
            (5, "", ""), (None, "http://a.example/none", "é<p>one</p>"), (9, "https://c.example/a\tb", "x\r\n\r\nWARC/1.1\r\n"),
            (9, "https://c.example/a\tb", "x\r\n\r\nWARC/1.1\r\n"), (11, "not a url %", "z" * 100_000),
            (12, "http://[broken", "unique")]
    df = spark.createDataFrame([(*r, "s") for r in rows], PAGES)
    got = warc.archive_round_trip(df).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    assert sorted(map(tuple, got.collect()), key=repr) == by_hand(rows)


def test_empty_table(spark):
    assert warc.archive_round_trip(spark.createDataFrame([], PAGES)).count() == 0


def test_lookup_reads_the_records_of_a_url(spark):
    rows = [(i, f"http://h{i % 7}.example/p{i % 50}", f"page {i}", "s") for i in range(400)]
    rows += [(1000 + i, "http://hot.example/", f"capture {i}", "s") for i in range(300)]
    folder = scratch_path(spark, "warc-test")
    captures = warc.write_archives(spark.createDataFrame(rows, PAGES), f"{folder}/a")
    shards = warc.build_index(captures, f"{folder}/i", block_lines=16)
    assert shards.agg({"n_rows": "sum"}).first()[0] == 700
    asked = ["http://hot.example/", "http://www.h3.example/p3", "http://absent.example/"]
    found = warc.lookup(spark.createDataFrame([(u,) for u in asked], "url string"), shards, f"{folder}/i")
    records = warc.read_records(found, f"{folder}/a").collect()
    want = {i for i, u, *_ in rows if u in ("http://hot.example/", "http://h3.example/p3")}
    assert {r.page_id for r in records} == want and len(records) == len(want)
    assert all(r.payload in (f"page {r.page_id}", f"capture {r.page_id - 1000}") for r in records)


def test_lookup_of_all_urls_equals_the_walk(spark):
    odd = ["http://a.example/x\ty", "http://a.example/x!y", "http://a.example/x%y", "http://a.example/X!y", None, "", "not a url",
           "http://b\u00e9.example/\u4e2d", "http://www.a.example/x!y"]
    rows = [(i, odd[i % len(odd)], f"page {i}", "s") for i in range(200)] + [
        (1000 + i, "http://hot.example/", f"capture {i}", "s") for i in range(500)]
    folder, pages = scratch_path(spark, "warc-test"), spark.createDataFrame(rows, PAGES)
    captures = warc.write_archives(pages, f"{folder}/a")
    # Small shards are kept apart, so that the hot key fills several.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        shards = warc.build_index(captures, f"{folder}/i", block_lines=8)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    hot = warc.url_key("http://hot.example/")
    assert shards.where((F.col("first_key") <= hot) & (F.col("last_key") >= hot)).count() > 1
    walked = sorted(map(tuple, warc.read_index(shards, f"{folder}/i").collect()))
    found = sorted(map(tuple, warc.lookup(pages.select("url"), shards, f"{folder}/i").collect()))
    assert len(found) == 700 and found == walked


def test_damage_is_noticed():
    record = warc._record(1, "http://a.example/", b"payload", "A" * 32, 1)
    with pytest.raises(ValueError, match="damaged"):
        warc._parse(record)


@pytest.mark.parametrize("url, key", [
    ("http://www.a.example/P?Q=1", "example,a)/p?q=1"), ("https://a.example:443", "example,a)/"),
    ("http://a.example:81/x", "example,a:81)/x"), (None, ""), ("", "")])
def test_keys(url, key):
    assert warc.url_key(url) == key
