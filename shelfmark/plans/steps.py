"""The four steps of a rebuild: list, records, catalog, publish.

Steps hand over through stored tables under one work folder, so a run can go on from any step. The
folder must be visible to all executors.
"""

from __future__ import annotations

import logging
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from shelfmark.errors import ArchiveError, RecordError
from shelfmark.operators.files import build_files, select_keys
from shelfmark.operators.gates import enforce, gate_report
from shelfmark.operators.links import linkages, media_links, model_links
from shelfmark.operators.models import scene_models
from shelfmark.operators.ranges import KeyRanges, assign_segments, key_boundaries
from shelfmark.operators.records import catalog_metadata, extract_records
from shelfmark.schemas import FILES, OUTPUTS
from shelfmark.sinks import tables as sink
from shelfmark.sources.records import ingest_records
from shelfmark.sources.scenes import load_scenes
from shelfmark.sources.tables import drop_path, read_if_exists, register, stage
from shelfmark.spec import CatalogSpec

logger = logging.getLogger(__name__)

STEPS = ("list", "records", "catalog", "publish")


@dataclass(frozen=True)
class Rebuild:
    """One rebuild: the archive, its work folder, the earlier release and the new one."""

    spark: SparkSession
    spec: CatalogSpec
    work: str
    target: str
    previous: str | None = None
    allow_malformed: bool = False
    bad_lines: str | None = None

    def path(self, name: str) -> str:
        return f"{self.work.rstrip('/')}/{name}"

    def listing(self) -> DataFrame:
        return self.spark.read.parquet(self.path("listing"))

    def metadata(self) -> DataFrame:
        """The three columns of the ingested records that the catalog uses."""
        return self.spark.read.parquet(self.path("records")).select("unitCode", "content", "filename")

    def register_inputs(self) -> None:
        """Let SQL see the inputs of the catalog step as ``listing`` and ``metadata``."""
        register(self.spark, {"listing": self.listing(), "metadata": self.metadata()})

    def previous_tables(self) -> dict[str, DataFrame | None]:
        """The tables of the earlier release; None for each that does not exist."""
        if self.previous is None:
            return {o.name: None for o in OUTPUTS}
        return {o.name: read_if_exists(self.spark, sink.table_path(self.previous, o)) for o in OUTPUTS}

    def paths_like(self, pattern: str) -> list[str]:
        """Paths of the listed objects that match; the file reader needs them on the driver."""
        return [self.spec.object_url(r["key"]) for r in select_keys(self.listing(), pattern).collect()]

    def list_step(self, inventory: DataFrame) -> int:
        """Cut the inventory into segments, store them, audit them and merge them."""
        before = self.previous_tables()[FILES.name]
        ranges = KeyRanges(key_boundaries(before, self.spec) if before is not None else [])
        sink.write_segments(assign_segments(inventory, ranges), self.path("segments"))
        shards = self.spark.read.parquet(self.path("segments"))
        previous_rows = before.count() if before is not None else None
        keys = sink.merge_listing(shards, ranges, self.spec, self.path("listing"), previous_rows)
        drop_path(self.spark, self.path("segments"))
        return keys

    def records_step(self) -> int:
        """Copy the listed record files to Parquet."""
        paths = self.paths_like(self.spec.record_file_pattern)
        return ingest_records(self.spark, paths, self.path("records"), self.bad_lines)

    def catalog_step(self) -> dict[str, int]:
        """Build, write and validate the three tables.

        Three intermediate tables are stored because they are read more than once: the narrow
        records (so JSON is parsed once), the scenes (so small files are read once) and the links.
        """
        spec, listing = self.spec, self.listing()
        records = stage(extract_records(self.metadata(), spec), self.path("extracted"))
        malformed = records.where("malformed").count()
        if malformed and not self.allow_malformed:
            raise RecordError(f"{malformed} records hold content that is not JSON")

        scene_paths = self.paths_like(spec.scene_key_pattern)
        scenes, _ = load_scenes(self.spark, scene_paths, self.path("scenes"), spec, self.path("bad-scenes"))
        models = scene_models(scenes, spec)

        # keys are unique: the listing passed its audit
        media = media_links(records, listing, spec, unique_keys=True)
        links = linkages(media, model_links(models, listing, spec, unique_keys=True))
        links = stage(links, self.path("links"))
        tables = {
            "files": build_files(listing, spec),
            "metadata": catalog_metadata(records, links, models),
            "linkages": links,
        }
        counts = sink.write_catalog(tables, self.path("catalog"))
        stored = sink.read_catalog(self.spark, self.path("catalog"))
        enforce(gate_report(stored, spec, self.previous_tables()))
        return counts

    def publish_step(self) -> dict[str, int]:
        """Validate once more and store the new release."""
        before = self.previous_tables()
        return sink.publish(self.spark, self.path("catalog"), self.target, self.spec, before)

    def run(self, inventory: DataFrame | None = None, steps: Sequence[str] = STEPS) -> dict[str, object]:
        """Run the given steps in their order; returns what each one counted."""
        unknown = set(steps) - set(STEPS)
        if unknown:
            raise ArchiveError(f"unknown steps: {sorted(unknown)}")
        if "list" in steps and inventory is None:
            raise ArchiveError("the list step needs an inventory")
        work = {
            "list": lambda: self.list_step(inventory),
            "records": self.records_step,
            "catalog": self.catalog_step,
            "publish": self.publish_step,
        }
        results = {}
        for step in STEPS:
            if step in steps:
                results[step] = work[step]()
                logger.info("%s: %s", step, results[step])
        return results
