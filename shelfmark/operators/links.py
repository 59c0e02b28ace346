"""Links between files and records: by file name for media, by folder id for 3D models."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.functions.names import file_name, model_id, public_url
from shelfmark.operators.files import is_file
from shelfmark.operators.hot_join import spread_join
from shelfmark.sources.tables import scratch_path, stage
from shelfmark.spec import CatalogSpec


def media_references(records: DataFrame) -> DataFrame:
    """``(record_id, file_name)`` for every distinct mention of a file by a record."""
    # a plain explode would make the optimizer test the list below it too, and so compute it twice
    named = records.select("record_id", F.explode_outer("media_names").alias("file_name"))
    return named.where("file_name IS NOT NULL").distinct()


def media_links(
    records: DataFrame, listing: DataFrame, spec: CatalogSpec, unique_keys: bool = False
) -> DataFrame:
    """Distinct ``(url, record_id)`` of media files whose name a record mentions.

    ``records`` is the result of ``extract_records``. Both sides are made distinct before the join,
    where they are smallest; as a url has one file name, their pairs are then distinct too and the
    much larger result needs no shuffle of its own. A listing that passed its coverage audit has
    unique keys, which ``unique_keys`` states to save the shuffle on that side.

    Files of other extensions cannot be mentioned and are dropped first. Both narrow sides are
    stored, since the join reads each twice.
    """
    key = F.col("key")
    wanted = key.startswith(spec.media_prefix) & F.rlike(F.lower(key), F.lit(spec.link_name_pattern))
    files = listing.where(wanted).select(file_name(key).alias("file_name"), public_url(key, spec).alias("url"))
    if not unique_keys:
        files = files.distinct()
    spark = records.sparkSession
    mentions = stage(media_references(records), scratch_path(spark, "mentions"))
    files = stage(files, scratch_path(spark, "media-files"))
    return spread_join(mentions, files, "file_name").select("url", "record_id")


def model_links(
    models: DataFrame, listing: DataFrame, spec: CatalogSpec, unique_keys: bool = False
) -> DataFrame:
    """Distinct ``(url, record_id)`` linking every file of a 3D model to that model's record."""
    key = F.col("key")
    wanted = key.startswith(spec.models_prefix) & F.rlike(key, F.lit(spec.model_pattern)) & is_file()
    files = listing.where(wanted).select(model_id(key, spec).alias("model_id"), public_url(key, spec).alias("url"))
    if not unique_keys:
        files = files.distinct()
    owners = models.select("model_id", "record_id").distinct()
    # an owner a model: a folder of very many files is split by adaptive execution, which copies one row
    return files.join(owners, "model_id").select("url", "record_id")


def linkages(media: DataFrame, models: DataFrame) -> DataFrame:
    """Both link sets as one; disjoint, because their urls lie in different folders."""
    columns = ["url", "record_id"]
    return media.select(columns).unionByName(models.select(columns))
