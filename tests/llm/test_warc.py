import base64
import glob
import gzip
import hashlib
import random

import pytest
from pyspark.sql import functions as F

from shelfmark.llm import warc
from shelfmark.sources.tables import scratch_path
from tests.llm.odd import sentence

SCHEMA = "page_id bigint, url string, html string"


def odd_pages(rng):
    hot = sentence(rng, 40)
    rows = [(n, f"http://h{n % 7}.example.org/{n % 50}", hot if n % 3 == 0 else sentence(rng, 30)) for n in range(200)]
    rows += [(300, None, None), (301, "", ""), (302, "not a url", None), (None, "http://x.org/", "no id"), (None, "http://x.org/", "no id")]
    rows += [(303, "http://x.org/\r\n\r\nWARC/1.1", "a\r\n\r\nb" + "\x00\x1f\x8b"), (304, "https://u:p@WWW.Ex.com:443?q=1#f", "é" * 70_000)]
    rows += [(305, "u", "same row")] * 3 + [(-5, "http://x.org/?-5", "negative"), (7, "http://other.org", "another page of one id")]
    rows += [(400 + n, "http://one.example/", f"capture {n}") for n in range(40)]
    return rows


def brute(rows):
    found = []
    texts = [(p, (h or "").encode()) for p, _, h in rows]
    firsts, used = {}, set()
    for p, h in texts:
        if h not in firsts or (p is not None and (firsts[h] is None or p < firsts[h])):
            firsts[h] = p
    for p, h in texts:
        digest = base64.b32encode(hashlib.sha1(h).digest()).decode()
        response = p == firsts[h] and h not in used
        used |= {h} if response else set()
        found.append((p, len(h), digest, "response" if response else "revisit", None if response else firsts[h]))
    return sorted(found, key=repr)


def test_pages_come_back_through_the_index(spark, monkeypatch):
    monkeypatch.setattr(warc, "BLOCK", 7)
    monkeypatch.setattr(warc, "SHARD_ENTRIES", 40)
    monkeypatch.setattr(warc, "FILE_RECORDS", 13)
    rows = odd_pages(random.Random(1))
    found = warc.op4(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted(map(tuple, found), key=repr) == brute(rows)


def test_archives_are_gzip_files_of_warc_records(spark):
    rows = [(1, "http://a.org/", "x\r\n\r\ny"), (2, None, None), (3, "http://b.org/", "x\r\n\r\ny")]
    path = scratch_path(spark, "archive")
    warc.write_archive(spark.createDataFrame(rows, SCHEMA).coalesce(1), path)
    files = glob.glob(f"{path.removeprefix('file:')}/part-*")
    whole = b"".join(gzip.open(f).read() for f in files)  # the usual reader sees one stream
    assert whole.count(b"WARC/1.1\r\n") == 3 and whole.count(b"x\r\n\r\ny") == 1
    entries = warc.archive_files(spark, path).collect()
    assert sum(len(list(warc.members(memoryview(bytes(e.content))))) for e in entries) == 3


def test_look_up_reads_only_what_is_asked(spark):
    rows = odd_pages(random.Random(2))
    pages = spark.createDataFrame(rows, SCHEMA)
    archive, index = scratch_path(spark, "archive"), scratch_path(spark, "index")
    warc.write_archive(pages, archive)
    warc.build_index(spark, archive, index)
    asked = pages.where("page_id IN (5, 304, 410)").select(warc.capture_key(F.col("url"), F.col("page_id")).alias("key"))
    asked = asked.union(spark.createDataFrame([("zzz",), ("",), (None,)], "key string"))
    found = {r.page_id: r.html for r in warc.read_records(spark, archive, warc.look_up(spark, index, asked)).collect()}
    assert found == {p: h for p, _, h in rows if p in (5, 304, 410)}


@pytest.mark.parametrize(
    ("url", "key"),
    [
        ("http://www.Example.com/A/b?c=D#e", "com,example)/A/b?c=D"),
        ("https://u:p@sub.example.org:8443", "org,example,sub:8443)/"),
        ("http://example.org:80?x", "org,example)/?x"),
        ("mailto:x", "mailto:x"),
        ("", ""),
        (None, "-"),
    ],
)
def test_url_keys(spark, url, key):
    assert spark.createDataFrame([(url,)], "u string").select(warc.surt(F.col("u"))).first()[0] == key


def test_short_payloads_are_no_revisits(spark):
    path = scratch_path(spark, "archive")
    rows = [(1, "a", "x"), (2, "b", "x"), (3, "c", "long enough"), (4, "d", "long enough")]
    warc.write_archive(spark.createDataFrame(rows, SCHEMA), path, min_bytes=5)
    index = scratch_path(spark, "index")
    warc.build_index(spark, path, index)
    keys = spark.createDataFrame(rows, SCHEMA).select(warc.capture_key(F.col("url"), F.col("page_id")).alias("key"))
    found = warc.read_records(spark, path, warc.look_up(spark, index, keys)).collect()
    assert {r.page_id: (r.record_type, r.refers_to) for r in found} == {
        1: ("response", None), 2: ("response", None), 3: ("response", None), 4: ("revisit", 3),
    }


def test_empty_table(spark):
    assert warc.op4(spark.createDataFrame([], SCHEMA)).collect() == []
