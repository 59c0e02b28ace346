import tempfile

import pytest
from pyspark.sql import SparkSession

from shelfmark.sources.tables import clear_scratch
from shelfmark.spec import CatalogSpec

MODEL = "model-of-a-brass-sextant-from-1790-x7"[:36]


@pytest.fixture(scope="session")
def spark():
    builder = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="warehouse-"))
    )
    session = builder.getOrCreate()
    if not session.conf.get("spark.checkpoint.dir", None):  # which cannot be set later on
        session.stop()
        session = builder.config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="checkpoints-")).getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    clear_scratch(session)
    session.stop()


@pytest.fixture
def spec(tmp_path):
    """An archive whose store is a folder of this test."""
    return CatalogSpec("arc/pub", f"file://{tmp_path}/store/", "https://files.example/", segments=4)
