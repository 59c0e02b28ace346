"""Declared schemas. Nothing in the package infers a schema from data."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T


def _strings(*names: str) -> list[T.StructField]:
    return [T.StructField(name, T.StringType()) for name in names]


LISTING = T.StructType(
    [
        T.StructField("key", T.StringType()),
        T.StructField("size", T.LongType()),
        T.StructField("last_modified", T.TimestampType()),
        T.StructField("etag", T.StringType()),
    ]
)

SEGMENTS = T.StructType(
    [T.StructField("index", T.IntegerType()), *_strings("start_after", "end_inclusive")]
)

# Column names of the newline-delimited record files.
RECORD_LINES = T.StructType(
    [
        *_strings(
            "id", "version", "unitCode", "linkedId", "type", "content", "url", "hash", "docSignature"
        ),
        T.StructField("timestamp", T.LongType()),
        T.StructField("lastTimeUpdated", T.LongType()),
        *_strings("title"),
    ]
)

# The few fields of a record's JSON text that are ever read. A text that does not have this shape
# throughout is marked by the parser in _corrupt_record, and its media are then read part by part.
MEDIA_SHAPE = "ARRAY<STRUCT<resources: ARRAY<STRUCT<url: STRING>>>>"
RECORD_CONTENT = f"""
    record_id STRING, title STRING, guid STRING,
    descriptiveNonRepeating STRUCT<
        record_ID: STRING, unit_code: STRING, guid: STRING,
        title: STRUCT<content: STRING>,
        online_media: STRUCT<media: {MEDIA_SHAPE}>>,
    _corrupt_record STRING
"""
# Options for parsing with _corrupt_record. Stating the default mode keeps the optimizer from
# narrowing the schema to the fields in use, which would leave other fields' faults unnoticed.
WHOLE_SHAPE = {"mode": "PERMISSIVE"}

MEDIA_PATH = "$.descriptiveNonRepeating.online_media.media"

SCENE_FILE = T.StructType(_strings("metas", "_corrupt_record"))


@dataclass(frozen=True)
class Output:
    """One published table: its stored name, exact columns and sort order."""

    name: str
    schema: T.StructType
    sort: tuple[str, ...]

    @property
    def file(self) -> str:
        return f"{self.name}.parquet"

    @property
    def columns(self) -> list[str]:
        return self.schema.fieldNames()


FILES = Output(
    "files",
    T.StructType(
        [
            *_strings("url"),
            T.StructField("size", T.LongType()),
            T.StructField("last_modified", T.TimestampNTZType()),
        ]
    ),
    ("url",),
)
METADATA = Output(
    "metadata",
    T.StructType(_strings("unit_code", "record_id", "title", "guid", "metadata_url")),
    ("unit_code", "record_id", "title"),
)
LINKAGES = Output("linkages", T.StructType(_strings("url", "record_id")), ("url", "record_id"))

OUTPUTS = (FILES, METADATA, LINKAGES)

# A reader who joins through the links must never meet a link to a file or record that is not
# there yet, so files come last.
PUBLISH_ORDER = (METADATA, LINKAGES, FILES)
