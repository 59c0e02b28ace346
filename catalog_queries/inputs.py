"""An object archive derived from the given tables by projection, in Spark and in DuckDB SQL.

The given tables hold no archive, so orders become media files and records, suppliers become 3D
models and nations become record files. Nothing is gathered or shuffled on the way: every derived
row comes from one given row, so the archive grows with the tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.spec import CatalogSpec

SPEC = CatalogSpec("arc/pub", "s3://store/", "https://files.example/", segments=16)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_UNIT = "lower(replace(substr(o_orderpriority, 3), ' ', '_'))"
_NAME = "concat('ORD-', o_orderkey, element_at(array('.jpg', '.TIF', '.pdf', '.jpeg', '.txt'), cast(o_orderkey % 5 AS int) + 1))"
_THEN = "timestamp_ntz'2026-01-01 00:00:00'"
_MODEL = "lpad(cast(s_suppkey AS string), 36, '0')"
_RECORD_FILE = "concat('n', {n}, '/', lower(lpad(hex({n}), 2, '0')), '.txt')"


def listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """key, size, last_modified, etag.

    Orders give media files, every tenth of them a second time in another folder; suppliers two
    files of a model; nations a record file, a folder marker and two files of no interest.
    """
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority", "o_orderdate")
    media = orders.select(
        F.explode(
            F.expr(f"CASE WHEN o_orderkey % 10 = 3 THEN array({_UNIT}, 'copies') ELSE array({_UNIT}) END")
        ).alias("folder"),
        F.expr(_NAME).alias("name"),
        F.expr("o_custkey * 1000 + o_orderkey").alias("size"),
        F.col("o_orderdate").alias("last_modified"),
    ).select(F.expr("concat('arc/pub/media/', folder, '/', name)").alias("key"), "size", "last_modified")
    models = table(spark, sf_dir, "supplier").select(
        F.explode(F.array(F.lit("scene.svx.json"), F.lit("model.glb"))).alias("file"), "s_suppkey"
    ).select(
        F.expr(f"concat('arc/pub/3d/', {_MODEL}, '/', file)").alias("key"),
        F.col("s_suppkey").alias("size"),
        F.expr(_THEN).alias("last_modified"),
    )
    others = F.array(
        F.expr(f"concat('metadata/edan/', {_RECORD_FILE.format(n='n_nationkey')})"),
        F.expr("concat('media/n', n_nationkey, '/')"),
        F.expr("concat('README-', n_nationkey, '.md')"),
        F.expr("concat('3d/README-', n_nationkey, '.md')"),
    )
    strays = table(spark, sf_dir, "nation").select(F.explode(others).alias("rest")).select(
        F.concat(F.lit("arc/pub/"), "rest").alias("key"),
        F.length("rest").cast("long").alias("size"),
        F.expr(_THEN).alias("last_modified"),
    )
    return media.unionByName(models).unionByName(strays).withColumn("etag", F.md5("key"))


# One record an order. Every fourth names its customer, so that ids repeat; every eleventh is
# emitted twice from two files; every 13th mentions files that do not exist. Media come as a list
# with an odd element (% 17) or as an object instead of a list (% 19).
_RECORD_ID = "CASE WHEN o_orderkey % 4 = 0 THEN concat('cu_', o_custkey) ELSE concat('od_', o_orderkey) END"
_IDS = {
    "own": f"CASE WHEN o_orderkey % 13 = 0 THEN concat('ORD-x', o_orderkey, '.jpg') ELSE {_NAME} END",
    "next": "concat('ORD-', o_orderkey + 1, '.jpg')",
}
_CONTENT = """concat(
    '{',
    CASE WHEN o_custkey % 7 <> 0 THEN concat('"record_id":"', record_id, '",') ELSE '' END,
    CASE WHEN o_orderkey % 2 = 0 THEN concat('"title":"Order ', o_orderkey, '",') ELSE '' END,
    CASE WHEN o_orderkey % 5 < 3 THEN concat('"guid":"ark:/', o_orderkey, '",') ELSE '' END,
    '"descriptiveNonRepeating":{"record_ID":"', record_id, '","unit_code":"', unit, '",',
    CASE WHEN o_orderkey % 5 = 3 THEN concat('"guid":"ark:/n', o_orderkey, '",') ELSE '' END,
    '"title":{"label":"Title","content":"Nested ', o_orderkey, '"},"online_media":{"media":',
    CASE WHEN o_orderkey % 19 = 0 THEN '' ELSE '[' END,
    CASE WHEN o_orderkey % 17 = 0 AND o_orderkey % 19 <> 0 THEN '7,' ELSE '' END,
    '{"type":"Images","resources":[{"label":"a","url":"https://ids.example/dl?x=1&id=', own, '"},',
    '{"url":"https://ids.example/dl?id=', next, '&max=5"}]}',
    CASE WHEN o_orderkey % 19 = 0 THEN '' ELSE concat(
        ',{"resources":[{"url":"https://ids.example/dl?id=', own, '"},{"label":"no url"}]},{"type":"none"}]') END,
    '}}}'
)"""


def _records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """o_orderkey, unitCode, content, filename."""
    emitted = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        "o_custkey",
        F.expr(_RECORD_ID).alias("record_id"),
        F.expr(f"upper({_UNIT})").alias("unit"),
        F.expr(_IDS["own"]).alias("own"),
        F.expr(_IDS["next"]).alias("next"),
        F.explode(F.expr("CASE WHEN o_orderkey % 11 = 0 THEN array(0, 1) ELSE array(0) END")).alias("copy"),
    )
    number = "cast((o_custkey + copy) % 25 AS int)"
    return emitted.select(
        "o_orderkey",
        F.expr("CASE WHEN o_custkey % 3 = 0 THEN NULL ELSE unit END").alias("unitCode"),
        F.expr(_CONTENT).alias("content"),
        F.expr(f"concat('s3://store/arc/pub/metadata/edan/', {_RECORD_FILE.format(n=number)})").alias("filename"),
    )


def metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """unitCode, content, filename."""
    return _records(spark, sf_dir).drop("o_orderkey")


# Faults put into a text by its order: text behind the value, two values, marks that do not belong, a
# cut text; and a blank or names that repeat, which are none.
_FAULTY = """CASE o_orderkey % 29
    WHEN 1 THEN concat({text}, ' junk') WHEN 2 THEN concat({text}, {text}) WHEN 3 THEN concat({text}, ',')
    WHEN 4 THEN concat({text}, ']') WHEN 5 THEN concat({text}, '}}') WHEN 6 THEN substr({text}, 1, length({text}) - 3)
    WHEN 7 THEN concat({text}, ' ') WHEN 8 THEN concat('{{"label":1,"label":2,', substr({text}, 2)) ELSE {text} END"""
# A line of a record file, the content as a JSON string.
_LINE = """concat('{{"id":"', md5(content), '","unitCode":', coalesce('"' || {unit} || '"', 'null'), ',"content":"',
    replace(content, '"', {quote}), '","timestamp":', length(content), '}}')"""


def faulty_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Like ``metadata``, with faults in the content."""
    content = F.expr(_FAULTY.format(text="content"))
    return _records(spark, sf_dir).withColumn("content", content).drop("o_orderkey")


def faulty_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(folder, line)``: lines of record files with faults in them."""
    line = F.expr(_LINE.format(unit="unitCode", quote="'\\\\\"'"))
    rows = _records(spark, sf_dir).withColumn("line", line)
    return rows.select(
        F.expr("concat('f', o_orderkey % 7)").alias("folder"), F.expr(_FAULTY.format(text="line")).alias("line")
    )


def record_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(key, line)``: the lines of the listed record files, each with the file it lies in."""
    line = F.expr(_LINE.format(unit="unitCode", quote="'\\\\\"'"))
    key = F.regexp_replace("filename", "^s3://store/", "")
    return _records(spark, sf_dir).select(key.alias("key"), line.alias("line"))


def scene_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(key, line)``: the text of each listed scene file."""
    return scenes(spark, sf_dir).select(
        F.regexp_replace("filename", "^s3://store/", "").alias("key"), F.expr("concat('{\"metas\":', metas, '}')").alias("line")
    )


def faulty_scenes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(model, text)``: scene files, one in 200 of them with text behind its value."""
    return table(spark, sf_dir, "supplier").select(
        F.expr(_MODEL).alias("model"),
        F.expr(f"concat('{{\"metas\":', {_METAS}, '}}', CASE WHEN s_suppkey % 200 = 7 THEN ' junk' ELSE '' END)").alias("text"),
    )


# One scene a supplier: two collections and an entry without one. Every fourth names a customer's
# record, every tenth has only an English title, every 25th ends in a null collection.
_METAS = """concat(
    '[{"collection":{"edanRecordId":"edanmdm:old_', s_suppkey, '","title":"Earlier cast"}},',
    '{"collection":{"edanRecordId":"edanmdm:',
    CASE WHEN s_suppkey % 4 = 0 THEN 'cu_' ELSE 'sup_' END, s_suppkey, '",',
    CASE WHEN s_suppkey % 10 = 0 THEN '' ELSE concat('"title":"Model ', s_suppkey, '",') END,
    '"titles":{"EN":"English ', s_suppkey, '"}}},{"uri":"x"}',
    CASE WHEN s_suppkey % 25 = 0 THEN ',{"collection":null}' ELSE '' END,
    ']')"""


def scenes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """filename, metas."""
    return table(spark, sf_dir, "supplier").select(
        F.expr(f"concat('s3://store/arc/pub/3d/', {_MODEL}, '/scene.svx.json')").alias("filename"),
        F.expr(_METAS).alias("metas"),
    )


# The same in DuckDB SQL.

_SQL_UNIT = _UNIT
_SQL_NAME = "'ORD-' || o_orderkey || (['.jpg', '.TIF', '.pdf', '.jpeg', '.txt'])[o_orderkey % 5 + 1]"
_SQL_THEN = "TIMESTAMP '2026-01-01 00:00:00'"
_SQL_RECORD_FILE = "'n' || {n} || '/' || lower(lpad(hex({n}), 2, '0')) || '.txt'"

LISTING_SQL = f"""
listing AS (
    SELECT key, size, last_modified, md5(key) AS etag FROM (
        SELECT 'arc/pub/media/' || {_SQL_UNIT} || '/' || {_SQL_NAME} AS key,
            o_custkey * 1000 + o_orderkey AS size, o_orderdate AS last_modified FROM orders
        UNION ALL
        SELECT 'arc/pub/media/copies/' || {_SQL_NAME}, o_custkey * 1000 + o_orderkey, o_orderdate
        FROM orders WHERE o_orderkey % 10 = 3
        UNION ALL
        SELECT 'arc/pub/3d/' || lpad(s_suppkey::VARCHAR, 36, '0') || '/' || f, s_suppkey, {_SQL_THEN}
        FROM supplier, (VALUES ('scene.svx.json'), ('model.glb')) t(f)
        UNION ALL
        SELECT 'arc/pub/' || rest, length(rest), {_SQL_THEN} FROM (
            SELECT unnest([
                'metadata/edan/' || {_SQL_RECORD_FILE.format(n='n_nationkey')},
                'media/n' || n_nationkey || '/',
                'README-' || n_nationkey || '.md',
                '3d/README-' || n_nationkey || '.md']) AS rest
            FROM nation)
    )
)"""

RECORDS_SQL = f"""
emitted AS (
    SELECT o_orderkey, o_custkey,
        CASE WHEN o_orderkey % 4 = 0 THEN 'cu_' || o_custkey ELSE 'od_' || o_orderkey END AS record_id,
        upper({_SQL_UNIT}) AS unit,
        CASE WHEN o_orderkey % 13 = 0 THEN 'ORD-x' || o_orderkey || '.jpg' ELSE {_SQL_NAME} END AS own,
        'ORD-' || (o_orderkey + 1) || '.jpg' AS "next",
        unnest(CASE WHEN o_orderkey % 11 = 0 THEN [0, 1] ELSE [0] END) AS "copy"
    FROM orders
), records AS (
    SELECT o_orderkey, CASE WHEN o_custkey % 3 = 0 THEN NULL ELSE unit END AS "unitCode",
        {_CONTENT} AS content,
        's3://store/arc/pub/metadata/edan/' || {_SQL_RECORD_FILE.format(n='((o_custkey + "copy") % 25)')} AS filename
    FROM emitted
)"""
METADATA_SQL = RECORDS_SQL + """, metadata AS (SELECT "unitCode", content, filename FROM records)"""

# The faulty texts as they are; DuckDB judges each, and only sound ones are looked into.
FAULTY_TEXTS_SQL = RECORDS_SQL + f""", texts AS (
    SELECT "unitCode", filename, {_FAULTY.format(text="content")} AS text FROM records
), metadata AS (
    SELECT "unitCode", filename, text, CASE WHEN json_valid(text) THEN text END AS content FROM texts
)"""
FAULTY_LINES_SQL = RECORDS_SQL + f""", written AS (
    SELECT *, {_LINE.format(unit='"unitCode"', quote="chr(92) || chr(34)")} AS line FROM records
), lines AS (
    SELECT 'f' || (o_orderkey % 7) AS folder, {_FAULTY.format(text="line")} AS line FROM written
)"""

FAULTY_SCENES_SQL = f"""
scene_texts AS (
    SELECT lpad(s_suppkey::VARCHAR, 36, '0') AS model,
        concat('{{"metas":', {_METAS}, '}}', CASE WHEN s_suppkey % 200 = 7 THEN ' junk' ELSE '' END) AS text
    FROM supplier
)"""

SCENES_SQL = f"""
svx_raw AS (
    SELECT 's3://store/arc/pub/3d/' || lpad(s_suppkey::VARCHAR, 36, '0') || '/scene.svx.json' AS filename,
        {_METAS} AS metas
    FROM supplier
)"""
