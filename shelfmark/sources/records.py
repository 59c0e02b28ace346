"""Newline-delimited record files."""

from __future__ import annotations

import logging
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfmark import schemas
from shelfmark.errors import RecordError
from shelfmark.functions.json_text import is_whole, not_json, parse_whole, whole_value
from shelfmark.functions.names import source_path
from shelfmark.sources.tables import drop_table, read_text, scratch_path, stage

logger = logging.getLogger(__name__)

BAD_LINE = "_corrupt_record"


def read_records_tolerantly(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """All lines of the files with the declared columns and their ``filename``.

    A line that is not exactly one JSON object of the declared types becomes a row that holds it in
    ``_corrupt_record``. Lines are read as text, because the JSON reader drops what follows a value.
    """
    declared = schemas.RECORD_LINES.fields
    lines = read_text(spark, paths).where(F.trim("value") != "")
    line = F.col("value")
    names = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in declared)
    once = lines.select("value", source_path().alias("filename"), parse_whole(line, names).alias("once"))
    judged = once.select("*", is_whole(F.col("once"), line).alias("whole"))
    # a second parse, and two that judge, only where the first proves nothing
    schema = T.StructType([*declared, T.StructField(BAD_LINE, T.StringType())])
    doubtful = F.when(~F.col("whole"), line)
    again = judged.select("*", F.from_json(doubtful, schema, schemas.WHOLE_SHAPE).alias("again"))
    fault = F.col(f"again.{BAD_LINE}").isNotNull() | not_json(doubtful)
    value = whole_value(F.col("once"))
    fields = [F.when(F.col("whole"), value[f.name]).otherwise(F.col(f"again.`{f.name}`")).alias(f.name) for f in declared]
    return again.select(*fields, F.when(fault, line).alias(BAD_LINE), "filename")


def read_records(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Like ``read_records_tolerantly``, but a bad line fails the read."""
    # a filter on nothing but deterministic columns would be moved below the parses, with a copy of each for every use
    judged = F.when(F.monotonically_increasing_id() >= 0, F.col(BAD_LINE))
    found = read_records_tolerantly(spark, paths).withColumn(BAD_LINE, judged)
    message = F.concat(F.lit("not one JSON record in "), "filename", F.lit(": "), F.substring(BAD_LINE, 1, 200))
    good = F.when(F.col(BAD_LINE).isNull(), True).otherwise(F.raise_error(message).cast("boolean"))
    return found.where(good).drop(BAD_LINE)


def split_bad_lines(records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """A tolerant read as (good records, bad lines with their file)."""
    bad = F.col(BAD_LINE).isNotNull()
    return records.where(~bad).drop(BAD_LINE), records.where(bad).select("filename", BAD_LINE)


def ingest_records(
    spark: SparkSession, paths: Sequence[str], out: str, bad_lines: str | None = None
) -> int:
    """Copy record files to Parquet, replacing what was there; returns the number of records.

    With ``bad_lines`` set, unreadable lines go to that table instead of failing the job. Files are
    read and parsed once, by all tasks, each writing its own part.
    """
    if not paths:
        raise RecordError("there are no record files")
    if bad_lines is None:
        read_records(spark, paths).write.mode("overwrite").parquet(out)
    else:
        parsed = stage(read_records_tolerantly(spark, paths), scratch_path(spark, "parsed-lines"))
        good, bad = split_bad_lines(parsed)
        good.write.mode("overwrite").parquet(out)
        bad.write.mode("overwrite").parquet(bad_lines)
        drop_table(parsed)
    written = spark.read.parquet(out)
    # a row a file is shuffled
    per_file = written.groupBy("filename").agg(F.count(F.lit(1)).alias("n"))
    found = per_file.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("rows"), F.count("filename").alias("files"))
    rows, files = found.first()
    if rows == 0:
        raise RecordError("no records were read")
    if files < len(paths):
        logger.warning("%d of %d record files held no records", len(paths) - files, len(paths))
    return rows
