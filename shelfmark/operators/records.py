"""Records: extraction from JSON text, one row per id, rows for models without a record."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfmark import schemas
from shelfmark.functions.json_text import as_variant, field_of, is_one_value, not_json, parts_of_field, parts_of_list
from shelfmark.functions.names import after, linked_name
from shelfmark.spec import CatalogSpec

# Which of several rows of one record is kept: the first in this order, nulls last.
KEEP_ORDER = ("metadata_url", "unit_code", "title", "guid")


def _odd_media_urls(content: Column) -> Column:
    """Resource urls of media of uneven shape: odd parts give nothing, the others are kept."""
    media = parts_of_list(F.get_json_object(content, schemas.MEDIA_PATH))
    resources = F.flatten(F.transform(media, lambda item: parts_of_field(item, "resources")))
    return F.transform(resources, lambda resource: F.get_json_object(resource, "$.url"))


def _media_names(urls: Column, spec: CatalogSpec) -> Column:
    """Distinct file names with a linkable extension among resource urls."""
    names = F.transform(F.coalesce(urls, F.array().cast("array<string>")), linked_name)
    pattern = F.lit(spec.link_name_pattern)
    return F.array_distinct(F.filter(names, lambda name: F.rlike(F.lower(name), pattern)))


def _flat_urls(resources: Column) -> Column:
    return F.flatten(F.filter(resources, lambda found: found.isNotNull()))["url"]


def _columns_of(record_id: Column, unit_code: Column, title: Column, guid: Column, urls: Column) -> Column:
    """What is kept of a record, as one struct."""
    return F.struct(
        record_id.alias("record_id"), unit_code.alias("unit_code"), title.alias("title"), guid.alias("guid"),
        F.when(record_id.isNotNull(), urls).alias("urls"),
    )


def _from_variant(parsed: Column) -> Column:
    """The columns of a record in a Variant; parts of odd shape give nothing, the others are kept."""

    def field(name: str, nested: str) -> Column:
        return F.coalesce(field_of(parsed, name), field_of(parsed, f"descriptiveNonRepeating.{nested}"))

    media = field_of(parsed, "descriptiveNonRepeating.online_media.media", schemas.MEDIA_SHAPE)
    return _columns_of(
        field("record_id", "record_ID"), field_of(parsed, "descriptiveNonRepeating.unit_code"), field("title", "title.content"),
        field("guid", "guid"), _flat_urls(media["resources"]),
    )


def _from_struct(record: Column, content: Column) -> Column:
    """The columns of a record that ``from_json`` read."""
    described = record["descriptiveNonRepeating"]
    urls = _flat_urls(described["online_media"]["media"]["resources"])
    # odd shapes are read part by part
    urls = F.when(record["_corrupt_record"].isNull(), urls).otherwise(_odd_media_urls(content))
    return _columns_of(
        F.coalesce(record["record_id"], described["record_ID"]), described["unit_code"],
        F.coalesce(record["title"], described["title"]["content"]), F.coalesce(record["guid"], described["guid"]), urls,
    )


def extract_records(metadata: DataFrame, spec: CatalogSpec) -> DataFrame:
    """The narrow record table: ids, titles, linked file names, from one parse of ``content``.

    ``metadata`` needs unitCode, content and filename. Result: record_id, unit_code, title, guid,
    metadata_url, media_names (NULL without a record_id) and malformed (content is not one JSON value). Write
    the result before using it twice, since each use parses again.

    The one parse, into a Variant, also proves a text to be one value, and its media may have any shape. Only texts
    that it refuses, which are faulty or repeat a name, are judged by two more parses and read by another.
    """
    content = F.col("content")
    once = metadata.select("unitCode", "content", "filename", as_variant(content).alias("once"))
    judged = once.select("*", is_one_value(F.col("once"), content).alias("whole"))
    doubtful = F.when(~F.col("whole"), content)
    judged = judged.select("*", F.coalesce(not_json(doubtful), F.lit(False)).alias("malformed"))
    sound = F.when(~F.col("whole") & ~F.col("malformed"), content)
    again = judged.select("*", F.from_json(sound, schemas.RECORD_CONTENT, schemas.WHOLE_SHAPE).alias("again"))
    record = F.when(F.col("whole"), _from_variant(F.col("once"))).otherwise(_from_struct(F.col("again"), sound))
    found = again.select("unitCode", "filename", "malformed", record.alias("r"))
    return found.select(
        "r.record_id",
        F.coalesce("unitCode", "r.unit_code").alias("unit_code"),
        "r.title",
        "r.guid",
        F.concat(F.lit(spec.records_url), after(F.col("filename"), spec.records_source)).alias("metadata_url"),
        F.when(F.col("r.record_id").isNotNull(), _media_names(F.col("r.urls"), spec)).alias("media_names"),
        "malformed",
    )


def keep_one(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The first row of each key by a total order, nulls last.

    Spark keeps only the best row a key has in each task before it shuffles, so a key with very
    many rows does not burden one task.
    """
    window = Window.partitionBy(*keys).orderBy(*[F.asc_nulls_last(c) for c in order])
    return df.withColumn("_place", F.row_number().over(window)).where("_place = 1").drop("_place")


def linked_records(records: DataFrame, links: DataFrame) -> DataFrame:
    """One row per record that has at least one link.

    Most records have none, so the semi join goes first; it leaves the rows placed by record_id, as
    the choice among rows of one record needs them.
    """
    columns = [*schemas.METADATA.columns]
    linked = records.where("record_id IS NOT NULL").select(columns)
    linked = linked.join(links.select("record_id").distinct(), "record_id", "left_semi")
    return keep_one(linked, ["record_id"], KEEP_ORDER).select(columns)


def _unit_of(record_id: str) -> Column:
    return F.upper(F.split_part(F.col(record_id), F.lit("_"), F.lit(1)))


def model_titles(models: DataFrame) -> DataFrame:
    """``(record_id, title)``: each model record once, with its smallest non-null title."""
    return models.groupBy("record_id").agg(F.min("title").alias("title"))


def synthetic_records(models: DataFrame, linked: DataFrame) -> DataFrame:
    """Minimal rows for model records that are not among the linked ones."""
    return (
        model_titles(models)
        .join(linked.select("record_id").distinct(), "record_id", "left_anti")
        .select(
            _unit_of("record_id").alias("unit_code"),
            "record_id",
            "title",
            F.lit(None).cast("string").alias("guid"),
            F.lit(None).cast("string").alias("metadata_url"),
        )
    )


def catalog_metadata(records: DataFrame, links: DataFrame, models: DataFrame) -> DataFrame:
    """Linked records, plus a synthetic row for each model record that is not one of them.

    Linked and synthetic rows come out of one full outer join, whose sides are already placed by
    record_id, so the linked records are computed once.
    """
    linked = linked_records(records, links).withColumn("_linked", F.lit(True))
    titles = model_titles(models).withColumnRenamed("title", "_model_title")
    found = F.col("_linked").isNotNull()
    return linked.join(titles, "record_id", "full_outer").select(
        F.when(found, F.col("unit_code")).otherwise(_unit_of("record_id")).alias("unit_code"),
        "record_id",
        F.when(found, F.col("title")).otherwise(F.col("_model_title")).alias("title"),
        "guid",
        "metadata_url",
    )
