"""WARC archives of pages, and a two-level capture index to read records back by URL.

Archives are written by Spark's text writer: each row is one record as a gzip member, and the line
separator is an empty gzip member, so that a file is a valid ``.warc.gz`` on any store and a lost task
leaves nothing behind. Equal payloads are stored once: the page with the smallest id is the response,
the others are revisits. Which payloads are repeated is known beforehand, as a bit sketch of fixed
size sieves them; only pages that may repeat one are shuffled.

The index has one entry a record: reversed-host URL key and page id, file, offset and length. Entries
are sorted, cut into blocks of ``BLOCK`` entries, and each block is compressed. The sparse directory
keeps the first key of each block, and the first keys of the at most ``MAX_SHARDS`` shards. A look-up
searches the shards, then the shard's directory, then decompresses the blocks that may hold the key,
and reads the records' ranges of bytes.

Defined cases: a null html is an empty payload; a null url is the key ``-``; rows without page_id sort
last and have the id ``-``; of rows that repeat the smallest page_id of a payload one is the response;
repeated rows are records of their own. An empty table gives no archive rows and an empty result; further columns
are ignored.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import json
import zlib
from bisect import bisect_left

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.functions.search import count_below
from shelfmark.llm.common import join_counted, maybe_in, sketch, staged
from shelfmark.sources.tables import scratch_path, stage

MIN_BYTES = 0  # payloads below are never revisits
FILE_RECORDS = 2_000
BLOCK = 500
SHARD_ENTRIES = 10_000
MAX_SHARDS = 4_096
DATE = "2000-01-01T00:00:00Z"
EMPTY_MEMBER = bytes.fromhex("1f8b08000000000000030300") + bytes(8)
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
PAGE = "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint"


def surt(url: Column) -> Column:
    """A URL with its host reversed: ``com,example)/path?query``; other texts as they are, null as ``-``."""
    scheme = r"^[A-Za-z][A-Za-z0-9+.\-]*://"
    host = F.lower(F.regexp_extract(url, scheme + r"(?:[^/?#@]*@)?(?:[wW]{3}\d*\.)?([^/?#:]*)", 1))
    port = F.regexp_extract(url, scheme + r"[^/?#]*?(:\d+)(?=[/?#]|$)", 1)
    port = F.when(port.isin(":80", ":443"), "").otherwise(port)
    rest = F.regexp_extract(url, scheme + r"[^/?#]*([^#]*)", 1)
    rest = F.when(rest.startswith("/"), rest).otherwise(F.concat(F.lit("/"), rest))
    key = F.concat(F.array_join(F.reverse(F.split(host, r"\.")), ","), port, F.lit(")"), rest)
    return F.when(url.isNull(), "-").when(url.rlike(scheme), key).otherwise(url)


def capture_key(url: Column, page_id: Column) -> Column:
    """What the index is sorted by: the URL key, then the page."""
    return F.concat(surt(url), F.lit(" "), F.coalesce(F.lpad(page_id.cast("string"), 20, "0"), F.lit("-")))


def base32(digest: bytes) -> str:
    return base64.b32encode(digest).decode()


def _header(text: str | None) -> str:
    """A header value: control characters as percent escapes."""
    return "".join(c if c.isprintable() else "".join(f"%{b:02X}" for b in c.encode()) for c in text or "")


def record(page_id: int | None, url: str | None, payload: bytes, revisit: bool, refers_to: int | None) -> bytes:
    """One WARC record as a gzip member."""
    digest = base32(hashlib.sha1(payload).digest())
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    name = hashlib.sha1(f"{page_id} {url} {digest}".encode("utf-8", "surrogatepass")).hexdigest()
    fields = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", f"<urn:uuid:{name[:8]}-{name[8:12]}-5{name[13:16]}-8{name[17:20]}-{name[20:32]}>"),
        ("WARC-Date", DATE),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
        ("Payload-Length", str(len(payload))),
    ]
    if url is not None:
        fields.append(("WARC-Target-URI", _header(url)))
        if _header(url) != url:
            fields.append(("Page-URL", json.dumps(url)))
    if page_id is not None:
        fields.append(("Page-ID", str(page_id)))
    if revisit:
        fields.append(("WARC-Profile", PROFILE))
        if refers_to is not None:
            fields.append(("Refers-To-Page-ID", str(refers_to)))
    head = "".join(f"{k}: {v}\r\n" for k, v in fields)
    return gzip.compress(b"WARC/1.1\r\n" + head.encode() + b"\r\n" + block + b"\r\n\r\n", 6, mtime=0)


def parse(member: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields and block of a record."""
    head, _, rest = member.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError(f"not a WARC record: {lines[0][:40]!r}")
    fields = dict(line.split(": ", 1) for line in lines[1:])
    return fields, rest[: int(fields["Content-Length"])]


def members(content: memoryview, step: int = 1 << 16):
    """``(offset, length, data)`` of the gzip members of a file that are not empty."""
    at = 0
    while at < len(content):
        unzip, parts, end = zlib.decompressobj(31), [], at
        while not unzip.eof and end < len(content):
            parts.append(unzip.decompress(content[end : end + step]))
            end = min(end + step, len(content))
        end -= len(unzip.unused_data)
        if not unzip.eof:
            raise ValueError("the archive ends within a record")
        data = b"".join(parts)
        if data:
            yield at, end - at, data
        at = end


def write_archive(pages: DataFrame, path: str, min_bytes: int = MIN_BYTES) -> None:
    """Write one record for each row ``(page_id, url, html)`` to files in a new folder ``path``."""
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select(
        F.col("page_id").cast("bigint").alias("page_id"), "url", "html",
        F.unhex(F.sha1(payload)).alias("digest"), F.xxhash64(F.sha1(payload)).alias("sieve"), F.length(payload).alias("bytes"),
    )
    repeated = rows.where(F.col("bytes") >= min_bytes).groupBy("sieve", "digest").agg(F.count("*").alias("n")).where("n > 1")
    repeated = staged(repeated, "repeated-payloads")
    seen = sketch(repeated, "sieve")
    some = staged(maybe_in(rows, seen, "sieve"), "maybe-repeated")
    some = some.select("*", F.struct("_metadata.file_path", "_metadata.row_index").alias("row"))
    first = F.min(F.struct(F.col("page_id").isNull().alias("none"), "page_id", "row"))
    firsts = some.groupBy("digest").agg(first.alias("first"), F.count("*").alias("n")).where("n > 1")
    marked = join_counted(some, firsts, "digest", "n", some.count())
    revisit = F.coalesce((F.col("bytes") >= min_bytes) & (F.col("row") != F.col("first.row")), F.lit(False))
    alone = maybe_in(rows, seen, "sieve", keep=False).select("page_id", "url", "html", F.lit(False).alias("revisit"), F.lit(None).cast("bigint").alias("to"))
    every = alone.union(marked.select("page_id", "url", "html", revisit, "first.page_id"))

    def write(batches):
        for batch in batches:
            columns = (batch.column(c) for c in ("page_id", "url", "html", "revisit", "to"))
            out = [record(p.as_py(), u.as_py(), (h.as_py() or "").encode(), r.as_py(), t.as_py()) for p, u, h, r, t in zip(*columns, strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["record"])

    lines = every.mapInArrow(write, "record binary").select(F.col("record").cast("string").alias("value"))
    writer = lines.write.option("lineSep", EMPTY_MEMBER.decode("latin-1")).option("encoding", "ISO-8859-1")
    writer.option("maxRecordsPerFile", FILE_RECORDS).text(path)


def archive_files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("path", "content")


def build_index(spark: SparkSession, archive: str, path: str) -> None:
    """Index the records of an archive: tables ``blocks`` and ``directory`` in a new folder ``path``."""

    def read(batches):
        for batch in batches:
            for name, content in zip(batch.column("path"), batch.column("content"), strict=True):
                found = []
                for offset, length, data in members(memoryview(content.as_buffer())):
                    fields, _ = parse(data)
                    page = fields.get("Page-ID")
                    url = json.loads(fields["Page-URL"]) if "Page-URL" in fields else fields.get("WARC-Target-URI")
                    found.append((name.as_py(), offset, length, url, int(page) if page is not None else None))
                if found:
                    types = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int64()]
                    columns = [pa.array(c, t) for c, t in zip(zip(*found, strict=True), types, strict=True)]
                    yield pa.RecordBatch.from_arrays(columns, ["file", "offset", "length", "url", "page_id"])

    captures = archive_files(spark, archive).mapInArrow(read, "file string, offset bigint, length bigint, url string, page_id bigint")
    captures = staged(captures.select(capture_key(F.col("url"), F.col("page_id")).alias("key"), "file", "offset", "length"), "captures")
    shards = min(max(1, -(-captures.count() // SHARD_ENTRIES)), MAX_SHARDS)

    def blocks(batches):
        waiting, number = [], 0

        def block(entries):
            data = zlib.compress("\n".join(json.dumps(e) for e in entries).encode())
            names = ["number", "first_key", "entries", "data"]
            return pa.RecordBatch.from_arrays([pa.array([number]), pa.array([entries[0][0]]), pa.array([len(entries)]), pa.array([data])], names)

        for batch in batches:
            waiting += zip(*(batch.column(c).to_pylist() for c in ("key", "file", "offset", "length")), strict=True)
            while len(waiting) >= BLOCK:
                yield block(waiting[:BLOCK])
                waiting, number = waiting[BLOCK:], number + 1
        if waiting:
            yield block(waiting)

    ordered = captures.repartitionByRange(shards, "key", "file", "offset").sortWithinPartitions("key", "file", "offset")
    cut = ordered.mapInArrow(blocks, "number bigint, first_key string, entries bigint, data binary")
    kept = stage(cut.withColumn("shard", F.spark_partition_id()), f"{path}/blocks")
    kept.select("shard", "number", "first_key", "entries").write.parquet(f"{path}/directory")


def _find(keys: list[str], first_keys: list[str], read_block) -> list[tuple[str, str, int, int]]:
    """Entries with one of some keys, from sorted blocks of which only the first keys are known."""
    found, kept = [], {}
    for key in sorted(set(keys)):
        at = max(bisect_left(first_keys, key) - 1, 0)
        while at < len(first_keys) and first_keys[at] <= key:
            if at not in kept:
                kept = {at: read_block(at)}
            entries = kept[at]
            n = bisect_left(entries, key, key=lambda e: e[0])
            while n < len(entries) and entries[n][0] == key:
                found.append(tuple(entries[n]))
                n += 1
            at += 1
    return found


def look_up(spark: SparkSession, index: str, keys: DataFrame) -> DataFrame:
    """``(key, file, offset, length)`` of every entry for one of ``keys (key)``."""
    directory = spark.read.parquet(f"{index}/directory")
    # at most MAX_SHARDS rows
    shards = directory.groupBy("shard").agg(F.min("first_key").alias("first_key")).orderBy("first_key", "shard").collect()
    bounds, numbers = [s.first_key for s in shards], [s.shard for s in shards]
    if not bounds:
        return spark.createDataFrame([], "key string, file string, offset bigint, length bigint")
    # a key lies in the last shard that starts below it, and in all that start with it
    low = F.greatest(count_below(F.col("key"), bounds) - 1, F.lit(0))
    high = F.greatest(count_below(F.concat("key", F.lit("\0")), bounds) - 1, low)
    asked = keys.where("key IS NOT NULL").select("key").distinct().select("key", F.explode(F.sequence(low, high)).alias("at"))
    asked = asked.select("key", F.get(F.lit(numbers), F.col("at")).alias("shard"))

    def search(wanted: pa.Table, blocks: pa.Table) -> pa.Table:
        blocks = blocks.sort_by("number")
        data = blocks["data"]
        found = _find(
            wanted["key"].to_pylist(), blocks["first_key"].to_pylist(),
            lambda n: [json.loads(line) for line in zlib.decompress(data[n].as_py()).decode().split("\n")],
        )
        columns = list(zip(*found, strict=True)) or [[]] * 4
        types = [pa.string(), pa.string(), pa.int64(), pa.int64()]
        return pa.table([pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["key", "file", "offset", "length"])

    blocks = spark.read.parquet(f"{index}/blocks").select("shard", "number", "first_key", "data")
    cells = asked.groupBy("shard").cogroup(blocks.groupBy("shard"))
    return cells.applyInArrow(search, "key string, file string, offset bigint, length bigint")


def read_records(spark: SparkSession, archive: str, entries: DataFrame) -> DataFrame:
    """The pages of index entries, read from their ranges of bytes; ``PAGE`` and ``html``, null for revisits."""
    ranges = entries.groupBy("file").agg(F.collect_list(F.struct("offset", "length")).alias("ranges"))
    files = archive_files(spark, archive).withColumnRenamed("path", "file").join(ranges, "file")
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "html"]

    def read(batches):
        for batch in batches:
            for content, wanted in zip(batch.column("content"), batch.column("ranges"), strict=True):
                data, out = memoryview(content.as_buffer()), []
                for r in wanted.as_py():
                    fields, block = parse(gzip.decompress(data[r["offset"] : r["offset"] + r["length"]]))
                    revisit = fields["WARC-Type"] == "revisit"
                    payload = None if revisit else block.partition(b"\r\n\r\n")[2]
                    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:") if revisit else base32(hashlib.sha1(payload).digest())
                    size = int(fields["Payload-Length"]) if revisit else len(payload)
                    page, to = (int(fields[f]) if f in fields else None for f in ("Page-ID", "Refers-To-Page-ID"))
                    out.append((page, size, digest, fields["WARC-Type"], to, None if revisit else payload.decode()))
                types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string()]
                columns = [pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, names)

    return files.mapInArrow(read, f"{PAGE}, html string")


def op4(pages: DataFrame) -> DataFrame:
    """Archive all pages, index the archive, look every page up and read its record back."""
    spark = pages.sparkSession
    archive, index = scratch_path(spark, "archive"), scratch_path(spark, "capture-index")
    write_archive(pages, archive)
    build_index(spark, archive, index)
    url = F.col("url")
    keys = pages.select(capture_key(url, F.col("page_id").cast("bigint")).alias("key"))
    return read_records(spark, archive, look_up(spark, index, keys)).drop("html")
