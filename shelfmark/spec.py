"""Where an archive lives and how its names are built.

Everything an operator needs to know about one archive is a field or a derived property of
``CatalogSpec``, so the same operators serve any archive with this layout.
"""

from __future__ import annotations

import re
from dataclasses import dataclass


@dataclass(frozen=True)
class CatalogSpec:
    """Layout of one archive.

    ``base_prefix`` is the folder of the archive inside its store, ``store_url`` the address objects
    are read from (``s3a://bucket/``), ``site_url`` the address published urls start with.
    """

    base_prefix: str
    store_url: str
    site_url: str

    # Names used by the archive's own files. They must match the data.
    media_dir: str = "media/"
    models_dir: str = "3d/"
    records_dir: str = "metadata/edan/"
    scene_file: str = "scene.svx.json"
    scene_id_field: str = "edanRecordId"
    scene_id_prefix: str = "edanmdm:"
    model_id_length: int = 36
    link_extensions: str = "(jpe?g|tiff?|pdf)"  # ends of file names, so without a slash

    # Tolerances of the checks.
    segments: int = 64
    max_drop_percent: float = 5.0
    min_fraction_of_previous: float = 0.5
    bad_scenes_floor: int = 5
    bad_scenes_per: int = 100

    @property
    def key_prefix(self) -> str:
        return f"{self.base_prefix}/"

    @property
    def base_url(self) -> str:
        return f"{self.site_url}{self.key_prefix}"

    @property
    def media_prefix(self) -> str:
        return self.key_prefix + self.media_dir

    @property
    def models_prefix(self) -> str:
        return self.key_prefix + self.models_dir

    @property
    def records_prefix(self) -> str:
        return self.key_prefix + self.records_dir

    @property
    def records_url(self) -> str:
        """Prefix of every published metadata url."""
        return self.base_url + self.records_dir

    @property
    def records_source(self) -> str:
        """Prefix of every record file as the reader names it."""
        return self.object_url(self.records_prefix)

    # The patterns below follow the archive's own names and must match the data. They are
    # searched with ``rlike`` and end in \z, not $: in Java $ also matches before a final newline.

    @property
    def record_file_pattern(self) -> str:
        return "^" + re.escape(self.records_prefix) + r"[^/]+/[0-9a-f]{2}\.txt\z"

    @property
    def model_pattern(self) -> str:
        return "^" + re.escape(self.models_prefix) + self._model_id + "/"

    @property
    def scene_key_pattern(self) -> str:
        return self.model_pattern + re.escape(self.scene_file) + r"\z"

    @property
    def scene_path_pattern(self) -> str:
        """Like ``scene_key_pattern``, for a scene file under any root."""
        return "/" + re.escape(self.models_dir) + self._model_id + "/" + re.escape(self.scene_file) + r"\z"

    @property
    def link_name_pattern(self) -> str:
        return self.link_extensions + r"\z"

    @property
    def _model_id(self) -> str:
        return "([^/]{" + str(self.model_id_length) + "})"

    def object_url(self, key: str) -> str:
        return f"{self.store_url}{key}"
