"""Scene files: one JSON document each."""

from __future__ import annotations

import logging
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark import schemas
from shelfmark.errors import SceneError
from shelfmark.functions.json_text import is_whole, not_json, parse_whole, whole_value
from shelfmark.functions.names import source_path
from shelfmark.sources.tables import read_text, stage
from shelfmark.spec import CatalogSpec

logger = logging.getLogger(__name__)


def read_scenes(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """``(filename, metas, problem)``: metas as JSON text, problem the text of an unparseable file.

    Each file is parsed on its own, so a bad one spoils no other; a file must hold one JSON value. An
    empty file gives no row.
    """
    texts = read_text(spark, paths, wholetext=True).where(F.trim("value") != "")
    text = F.col("value")
    once = texts.select(source_path().alias("filename"), "value", parse_whole(text, "metas STRING").alias("once"))
    judged = once.select("*", is_whole(F.col("once"), text).alias("whole"))
    doubtful = F.when(~F.col("whole"), text)
    again = judged.select("*", F.from_json(doubtful, schemas.SCENE_FILE, schemas.WHOLE_SHAPE).alias("again"))
    bad = F.coalesce(F.col("again._corrupt_record").isNotNull() | not_json(doubtful), F.lit(False))
    metas = F.when(F.col("whole"), whole_value(F.col("once"))["metas"]).otherwise(F.col("again.metas"))
    return again.select("filename", F.when(~bad, metas).alias("metas"), F.when(bad, text).alias("problem"))


def check_scenes(scenes: DataFrame, files: int, spec: CatalogSpec) -> DataFrame:
    """The bad files as ``(filename)``; raises when there are too many of them."""
    bad = scenes.where("problem IS NOT NULL").select("filename").distinct()
    count = bad.count()
    allowed = max(spec.bad_scenes_floor, files // spec.bad_scenes_per)
    if count > allowed:
        raise SceneError(f"{count} of {files} scene files failed to parse, at most {allowed} may")
    return bad


def load_scenes(
    spark: SparkSession, paths: Sequence[str], out: str, spec: CatalogSpec, bad_files: str
) -> tuple[DataFrame, DataFrame]:
    """Read scene files once into a stored table: ``(good scenes, bad files)``.

    The bad files, which are skipped, are stored at ``bad_files`` as ``(filename, problem)``.
    """
    scenes = stage(read_scenes(spark, paths), out)
    bad = stage(scenes.where("problem IS NOT NULL").select("filename", "problem").distinct(), bad_files)
    skipped = check_scenes(scenes, len(paths), spec).count()
    if skipped:
        logger.warning("skipped %d scene files that are not JSON documents, see %s", skipped, bad_files)
    return scenes.where("problem IS NULL AND metas IS NOT NULL").select("filename", "metas"), bad
