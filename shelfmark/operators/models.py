"""3D models: which record a scene file belongs to."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.functions.json_text import has_field, parts_of_list
from shelfmark.functions.names import after
from shelfmark.spec import CatalogSpec


def scene_models(scenes: DataFrame, spec: CatalogSpec) -> DataFrame:
    """``(model_id, record_id, title)`` from each scene's last ``metas`` entry with a collection.

    ``scenes`` needs filename and metas (JSON text). An entry whose collection is a JSON null still
    counts as the last one, and then yields no model. Works row by row, without a shuffle.
    """
    entries = F.filter(parts_of_list(F.col("metas")), lambda entry: has_field(entry, "collection"))
    last = scenes.select("filename", F.try_element_at(entries, F.lit(-1)).alias("entry"))

    def field(path: str):
        return F.get_json_object("entry", f"$.collection.{path}")

    return last.select(
        F.regexp_extract("filename", spec.scene_path_pattern, 1).alias("model_id"),
        # the prefix is cut by length and not compared
        after(field(spec.scene_id_field), spec.scene_id_prefix).alias("record_id"),
        F.coalesce(field("title"), field("titles.EN")).alias("title"),
    ).where("record_id != ''")
