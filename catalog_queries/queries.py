"""Every operator as a query ``(spark, sf_dir) -> DataFrame`` over whole tables."""

from __future__ import annotations

from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog_queries.inputs import (
    SPEC,
    faulty_lines,
    faulty_metadata,
    faulty_scenes,
    listing,
    metadata,
    record_lines,
    scene_texts,
    scenes,
    table,
)
from catalog_queries.store import write_files
from shelfmark import schemas
from shelfmark.functions.json_text import has_field, not_json
from shelfmark.functions.names import file_name, linked_name, naive_utc
from shelfmark.operators import files, gates, links, models, ranges, records
from shelfmark.operators.hot_join import spread_join
from shelfmark.operators.listing import coverage, offenders
from shelfmark.operators.order_audit import order_audit
from shelfmark.plans.steps import Rebuild
from shelfmark.sinks import tables as sink
from shelfmark.sources.inventory import read_inventory
from shelfmark.sources.records import ingest_records
from shelfmark.sources.scenes import load_scenes
from shelfmark.sources.tables import read_if_exists, register, scratch_path, stage


def _extracted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records.extract_records(metadata(spark, sf_dir), SPEC)


def _models(spark: SparkSession, sf_dir: str) -> DataFrame:
    return models.scene_models(scenes(spark, sf_dir), SPEC)


def files_catalog(spark, sf_dir):
    return files.build_files(listing(spark, sf_dir), SPEC)


def record_fields(spark, sf_dir):
    names = F.array_join(F.array_sort("media_names"), "|").alias("media_names")
    found = records.extract_records(faulty_metadata(spark, sf_dir), SPEC)
    return found.select("record_id", "unit_code", "title", "guid", "metadata_url", names, "malformed")


def media_references(spark, sf_dir):
    return links.media_references(_extracted(spark, sf_dir))


def media_links(spark, sf_dir):
    return links.media_links(_extracted(spark, sf_dir), listing(spark, sf_dir), SPEC)


def scene_models(spark, sf_dir):
    return _models(spark, sf_dir)


def model_links(spark, sf_dir):
    return links.model_links(_models(spark, sf_dir), listing(spark, sf_dir), SPEC)


def _stored_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The listing as the job has it: a stored table, since it is read more than once."""
    return stage(listing(spark, sf_dir), scratch_path(spark, "listing"))


def _links(found: DataFrame, listed: DataFrame, known: DataFrame) -> DataFrame:
    return links.linkages(links.media_links(found, listed, SPEC), links.model_links(known, listed, SPEC))


def linkages(spark, sf_dir):
    return _links(_extracted(spark, sf_dir), _stored_listing(spark, sf_dir), _models(spark, sf_dir))


def _stored_inputs(spark, sf_dir, listed=None):
    """Records and links as the job has them: stored too."""
    listed = _stored_listing(spark, sf_dir) if listed is None else listed
    found = stage(_extracted(spark, sf_dir), scratch_path(spark, "extracted"))
    known = _models(spark, sf_dir)
    return found, stage(_links(found, listed, known), scratch_path(spark, "links")), known


def linked_records(spark, sf_dir):
    found, both, _ = _stored_inputs(spark, sf_dir)
    return records.linked_records(found, both)


def synthetic_records(spark, sf_dir):
    found, both, known = _stored_inputs(spark, sf_dir)
    return records.synthetic_records(known, records.linked_records(found, both))


def metadata_catalog(spark, sf_dir):
    return records.catalog_metadata(*_stored_inputs(spark, sf_dir))


def dedupe_keep_one(spark, sf_dir):
    order = ("l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount",
             "l_tax", "l_returnflag", "l_linestatus", "l_shipdate")
    kept = records.keep_one(table(spark, sf_dir, "lineitem"), ["l_orderkey"], order)
    return kept.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate")


def _as_rows(spark, values, name):
    return spark.createDataFrame([(v,) for v in values], f"{name} string")


def _boundaries(listed: DataFrame) -> list[str]:
    """Boundaries by the files catalog of a stored listing, in place of an earlier release."""
    return ranges.key_boundaries(files.build_files(listed, SPEC), SPEC)


def _ranges(listed: DataFrame) -> ranges.KeyRanges:
    return ranges.KeyRanges(_boundaries(listed))


def key_boundaries(spark, sf_dir):
    return _as_rows(spark, _boundaries(_stored_listing(spark, sf_dir)), "boundary")


def page_url_quantiles(spark, sf_dir):
    return _as_rows(spark, ranges.exact_quantiles(table(spark, sf_dir, "pages"), "url", 64), "url")


def document_source_quantiles(spark, sf_dir):
    """Few values with very many copies each."""
    return _as_rows(spark, ranges.exact_quantiles(table(spark, sf_dir, "documents"), "source", 10), "source")


def range_segments(spark, sf_dir):
    boundaries = _boundaries(_stored_listing(spark, sf_dir))
    return ranges.KeyRanges(boundaries).frame(spark)


def assign_segments(spark, sf_dir):
    listed = _stored_listing(spark, sf_dir)
    return ranges.assign_segments(listed, _ranges(listed)).select("key", "segment")


def scan_segment(spark, sf_dir):
    """Every segment scanned, all in one scan of the stored shards; the union is the whole listing, each key once."""
    listed, path = _stored_listing(spark, sf_dir), scratch_path(spark, "shards")
    cut = _ranges(listed)
    sink.write_segments(ranges.assign_segments(listed, cut), path)
    scanned = ranges.scan_segments(spark.read.parquet(path), cut.frame(spark))
    return scanned.groupBy("segment").agg(F.count("key").alias("n"), F.min("key").alias("lowest"), F.max("key").alias("highest"))


def segmented_write(spark, sf_dir):
    listed = _stored_listing(spark, sf_dir)
    segmented = ranges.assign_segments(listed, _ranges(listed))
    return sink.write_segments(segmented, scratch_path(spark, "segments"))


def merge_listing(spark, sf_dir):
    """The listing written as shards, and these merged again."""
    listed, path, shards = _stored_listing(spark, sf_dir), scratch_path(spark, "merged"), scratch_path(spark, "shards")
    cut = _ranges(listed)
    sink.write_segments(ranges.assign_segments(listed, cut), shards)
    sink.merge_listing(spark.read.parquet(shards), cut, SPEC, path)
    return spark.read.parquet(path)


def coverage_audit(spark, sf_dir):
    listed = _stored_listing(spark, sf_dir)
    cut = _ranges(listed)
    return coverage(ranges.assign_segments(listed, cut), cut, SPEC)


def record_files(spark, sf_dir):
    return files.select_keys(listing(spark, sf_dir), SPEC.record_file_pattern)


def scene_files(spark, sf_dir):
    return files.select_keys(listing(spark, sf_dir), SPEC.scene_key_pattern)


def json_field_extract(spark, sf_dir):
    """A field of the events' JSON, and whether the text is one value and names it."""
    props = F.col("props")
    return table(spark, sf_dir, "events").select(
        "event_id", F.get_json_object(props, "$.k").alias("k"), has_field(props, "k").alias("named"), (~not_json(props)).alias("sound")
    )


def url_query_param(spark, sf_dir):
    """The file name of each page's URL and the value of its id parameter, once put there."""
    url = F.concat("url", F.when(F.contains("url", F.lit("?")), "&").otherwise("?"), F.lit("id="), F.col("page_id").cast("string"))
    return table(spark, sf_dir, "pages").select("page_id", file_name(F.col("url")).alias("name"), linked_name(url).alias("page"))


def malformed_documents(spark, sf_dir):
    """Record texts with faults of many kinds: how many of a file are not exactly one JSON value."""
    judged = faulty_metadata(spark, sf_dir).select("filename", not_json(F.col("content")).alias("bad"))
    return judged.groupBy("filename").agg(F.count_if("bad").alias("bad"), F.count_if(~F.col("bad")).alias("good"))


def record_ingest(spark, sf_dir):
    """Record lines, some of them faulty, written as text and ingested: good records and bad lines."""
    lines, out, bad = (scratch_path(spark, name) for name in ("lines", "records", "bad-lines"))
    faulty_lines(spark, sf_dir).select("folder", F.col("line").alias("value")).write.partitionBy("folder").text(lines)
    ingest_records(spark, [lines], out, bad)
    folder = F.regexp_extract("filename", "/folder=([^/]+)/", 1).alias("folder")
    columns = ["id", "unitCode", "content", "timestamp", "lastTimeUpdated", "title"]
    good = spark.read.parquet(out).select(*columns, folder, F.lit(None).cast("string").alias("bad_line"))
    set_aside = spark.read.parquet(bad).select(folder, F.col("_corrupt_record").alias("bad_line"))
    return good.unionByName(set_aside, allowMissingColumns=True)


def bad_scene_files(spark, sf_dir):
    """Scene files on disk, some with text behind their value: what is read and what is set aside."""
    root, out, bad = (scratch_path(spark, name) for name in ("scene-files", "scenes", "bad-scenes"))
    texts = faulty_scenes(spark, sf_dir)
    key = F.concat(F.lit("model="), "model", F.lit(f"/{SPEC.scene_file}"))
    root = write_files(texts.select(key.alias("key"), F.col("text").alias("line")), root)
    paths = [f"{root}/model={r['model']}/{SPEC.scene_file}" for r in texts.select("model").distinct().collect()]
    good, skipped = load_scenes(spark, paths, out, SPEC, bad)
    model = F.regexp_extract("filename", "/model=([^/]+)/", 1).alias("model")
    both = good.select(model, "metas", F.lit(None).cast("string").alias("problem"))
    return both.union(skipped.select(model, F.lit(None).cast("string"), F.regexp_replace("problem", "\n$", "")))


def inventory(spark, sf_dir):
    """A stored inventory with quoted etags, unsigned sizes and instants, as a listing in UTC."""
    path = scratch_path(spark, "inventory")
    listing(spark, sf_dir).select(
        "key", F.col("size").cast("decimal(20,0)").alias("size"),
        F.to_utc_timestamp(F.col("last_modified").cast("timestamp"), "UTC").alias("last_modified"),
        F.concat(F.lit('"'), "etag", F.lit('"')).alias("etag"),
    ).write.parquet(path)
    found = read_inventory(spark, path)
    return found.withColumn("last_modified", naive_utc(F.col("last_modified")))


def rebuild(spark, sf_dir):
    """The whole job on a tree of record and scene files: what it publishes."""
    texts = record_lines(spark, sf_dir).unionByName(scene_texts(spark, sf_dir))
    root = write_files(texts, scratch_path(spark, "store"))
    spec = replace(SPEC, store_url=f"{root}/")
    job = Rebuild(spark, spec, scratch_path(spark, "work"), scratch_path(spark, "release"))
    job.run(listing(spark, sf_dir))
    return _as_one(sink.read_catalog(spark, job.target))


def earlier_release(spark, sf_dir):
    """Rows of the tables of an earlier release, null for one that does not exist."""
    root = _catalog(spark, sf_dir)
    counts = []
    for name in ("files", "metadata", "linkages", "absent"):
        found = read_if_exists(spark, f"{root}/{name}.parquet")
        n = F.lit(None).cast("bigint") if found is None else F.count(F.lit(1))
        rows = spark.range(1) if found is None else found
        counts.append(rows.agg(F.max(F.lit(name)).alias("name"), F.max(n).alias("n") if found is None else n.alias("n")))
    return reduce(DataFrame.union, counts)


HOT_PAIRS = 10_000


def hot_media_links(spark, sf_dir):
    """One file name in the folders of all suppliers that a fifth of all records mention, and other names.

    The hot name is split into cells of ``HOT_PAIRS`` pairs; its pairs are summed up by file.
    """
    urgent = "CASE WHEN o_orderpriority = '1-URGENT' THEN 'hot.jpg' ELSE concat('s', o_orderkey % 1000, '.jpg') END"
    mentions = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("record"), F.expr(urgent).alias("name"))
    files = table(spark, sf_dir, "supplier").select(
        "s_suppkey", F.explode(F.array(F.lit("hot.jpg"), F.expr("concat('s', s_suppkey, '.jpg')"))).alias("name")
    )
    # a file meets all its records in a row, so that neighbouring pairs belong to one sum
    pairs = spread_join(files, mentions, "name", HOT_PAIRS)
    return pairs.groupBy("name", "s_suppkey").agg(
        F.count("*").alias("n"), F.min("record").alias("first"), F.max("record").alias("last"), F.sum("record").alias("total")
    )


def gate_schema(spark, sf_dir):
    good = files_catalog(spark, sf_dir)
    wrong = good.select("url", F.col("size").cast("int").alias("size"), "last_modified")
    reports = [gates.schema_gate(good, schemas.FILES), gates.schema_gate(wrong, schemas.FILES), gates.present_gate(wrong, "files filled")]
    return reduce(DataFrame.union, reports)


def gate_drift(spark, sf_dir):
    orders, lines, people = (table(spark, sf_dir, t) for t in ("orders", "lineitem", "customer"))
    reports = [
        gates.drift_gate(lines, orders, "grown", 5.0),
        gates.drift_gate(orders, orders, "same", 5.0),
        gates.drift_gate(people, orders, "shrunk", 5.0),
        gates.drift_gate(people, None, "first", 5.0),
    ]
    return reduce(DataFrame.union, reports)


def gate_unique(spark, sf_dir):
    orders, lines, pages = (table(spark, sf_dir, t) for t in ("orders", "lineitem", "pages"))
    reports = [
        gates.unique_gate(orders, "o_orderkey", "orders"),
        gates.unique_gate(lines, "l_orderkey", "lines"),
        gates.unique_gate(pages, "url", "pages"),
        gates.unique_gate(metadata(spark, sf_dir).select("unitCode"), "unitCode", "units"),
    ]
    return reduce(DataFrame.union, reports)


def gate_present(spark, sf_dir):
    return gates.present_gate(table(spark, sf_dir, "lineitem"), "lines present")


def gate_reference(spark, sf_dir):
    orders, lines = table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem")
    labels, documents = table(spark, sf_dir, "labels"), table(spark, sf_dir, "documents")
    mentions = links.media_references(_extracted(spark, sf_dir))
    stored = listing(spark, sf_dir).select(file_name(F.col("key")).alias("file_name"))
    reports = [
        gates.reference_gate(lines.select(F.col("l_orderkey").alias("o_orderkey")), orders, "o_orderkey", "lines"),
        gates.reference_gate(labels, documents, "doc_id", "labels"),
        gates.reference_gate(documents, labels, "doc_id", "documents"),
        gates.reference_gate(mentions, stored, "file_name", "mentions"),
    ]
    return reduce(DataFrame.union, reports)


def gate_prefix(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    reports = [
        gates.prefix_gate(files_catalog(spark, sf_dir), "url", SPEC.base_url, "files"),
        gates.prefix_gate(pages, "url", "https://", "pages"),
        gates.prefix_gate(_extracted(spark, sf_dir), "metadata_url", SPEC.records_url, "records"),
    ]
    return reduce(DataFrame.union, reports)


def _catalog(spark, sf_dir):
    """The three tables, written sorted to scratch space: their root."""
    listed = _stored_listing(spark, sf_dir)
    found, both, known = _stored_inputs(spark, sf_dir, listed)
    tables = {
        "files": files.build_files(listed, SPEC),
        "metadata": records.catalog_metadata(found, both, known),
        "linkages": both,
    }
    root = scratch_path(spark, "catalog")
    sink.write_catalog(tables, root)
    return root


def gate_report(spark, sf_dir):
    return gates.gate_report(sink.read_catalog(spark, _catalog(spark, sf_dir)), SPEC)


def gate_faults(spark, sf_dir):
    """All gates but those of stored order on a catalog with faults of every kind."""
    tables = dict(sink.read_catalog(spark, _catalog(spark, sf_dir)))
    nation, supplier = table(spark, sf_dir, "nation"), table(spark, sf_dir, "supplier")
    before = tables["files"].union(tables["files"])
    tables["files"] = tables["files"].union(tables["files"].where("size % 97 = 0")).union(
        nation.select(F.expr("concat('https://else.example/', n_nationkey)"), F.lit(-1), F.lit("2026-01-01").cast("timestamp_ntz"))
    )
    tables["metadata"] = tables["metadata"].union(
        nation.select(F.lit("X"), F.expr("CASE WHEN n_nationkey < 3 THEN '' WHEN n_nationkey < 7 THEN NULL ELSE 'n' END"),
                      F.lit("t"), F.lit(None), F.lit("https://else.example/r"))
    )
    tables["linkages"] = tables["linkages"].union(
        supplier.select(F.expr("concat('gone/', s_suppkey)"), F.expr("concat('nobody_', s_suppkey)"))
    )
    return gates.table_gates(tables, SPEC, {"files": before})


def _faulty_shards(spark, sf_dir):
    """A listing with foreign, repeated and misplaced keys, and its ranges."""
    listed = _stored_listing(spark, sf_dir)
    cut = _ranges(listed)
    placed = ranges.assign_segments(listed, cut)
    moved = placed.withColumn("segment", F.when(F.col("size") % 89 == 0, F.lit(1)).otherwise(F.col("segment")))
    foreign = listed.where("size % 83 = 0").withColumn("key", F.concat(F.lit("zzz/"), "key"))
    return moved.union(moved.where("size % 79 = 0")).union(ranges.assign_segments(foreign, cut)), cut


def coverage_faults(spark, sf_dir):
    """The coverage audit on a listing with foreign, repeated and misplaced keys."""
    return coverage(*_faulty_shards(spark, sf_dir), SPEC)


def coverage_offenders(spark, sf_dir):
    """The first key ranges that hold keys beyond their ends, as the audit names them."""
    return offenders(*_faulty_shards(spark, sf_dir), SPEC)


def registered_inputs(spark, sf_dir):
    """SQL over the inputs of the catalog step: units, their records, and files of their folder."""
    register(spark, {"listing": _stored_listing(spark, sf_dir), "metadata": metadata(spark, sf_dir)})
    return spark.sql("""
        WITH units AS (SELECT lower(unitCode) AS unit, count(*) AS records, count(DISTINCT filename) AS sources
                       FROM metadata WHERE unitCode IS NOT NULL GROUP BY ALL),
        folders AS (SELECT regexp_extract(key, '^arc/pub/media/([^/]+)/', 1) AS unit, count(*) AS files, sum(size) AS bytes
                    FROM listing GROUP BY ALL)
        SELECT unit, records, sources, files, bytes FROM units LEFT JOIN folders USING (unit)""")


def _as_one(tables) -> DataFrame:
    """The three tables as one, with the name of each."""
    named = [tables[o.name].withColumn("name", F.lit(o.name)) for o in schemas.OUTPUTS]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), named)


def catalog_write(spark, sf_dir):
    """The three tables as they are read back after the sorted write."""
    return _as_one(sink.read_catalog(spark, _catalog(spark, sf_dir)))


def catalog_sort_audit(spark, sf_dir):
    stored = sink.read_catalog(spark, _catalog(spark, sf_dir))
    audits = [
        order_audit(stored[o.name], o.sort).select(F.lit(o.name).alias("name"), "rows", "out_of_order")
        for o in schemas.OUTPUTS
    ]
    return reduce(DataFrame.union, audits)


def stored_order_audit(spark, sf_dir):
    """Neighbours out of order in the given files as they are stored."""
    columns = {"orders": ("o_orderkey",), "lineitem": ("l_orderkey", "l_linenumber"), "pages": ("url",)}
    audits = [
        order_audit(table(spark, sf_dir, name), keys).select(F.lit(name).alias("name"), "rows", "out_of_order")
        for name, keys in columns.items()
    ]
    return reduce(DataFrame.union, audits)


def publish(spark, sf_dir):
    staged, target = _catalog(spark, sf_dir), scratch_path(spark, "release")
    sink.publish(spark, staged, target, SPEC, sink.read_catalog(spark, staged))
    return _as_one(sink.read_catalog(spark, target))


QUERIES = {
    query.__name__: query
    for query in (
        files_catalog, record_fields, media_references, media_links, scene_models, model_links, linkages,
        linked_records, synthetic_records, metadata_catalog, dedupe_keep_one, key_boundaries,
        page_url_quantiles, document_source_quantiles, range_segments, assign_segments, scan_segment,
        segmented_write, merge_listing, coverage_audit, record_files, scene_files, json_field_extract,
        url_query_param, malformed_documents, record_ingest, gate_schema, gate_drift, gate_unique,
        gate_present, gate_reference, gate_prefix, gate_report, catalog_write, catalog_sort_audit,
        stored_order_audit, publish, bad_scene_files, inventory, earlier_release, hot_media_links, gate_faults,
        coverage_faults, coverage_offenders, registered_inputs, rebuild,
    )
}
