from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from pyspark.sql import SparkSession  # noqa: E402

from crmfunnel.sources.schemas import RAW_SCHEMAS  # noqa: E402
from crmfunnel.sources.session import tune  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[*]").appName("tests")
        .config("spark.sql.shuffle.partitions", "8").config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate())
    session.sparkContext.setLogLevel("ERROR")
    yield tune(session)
    session.stop()


@pytest.fixture(scope="session")
def tables(spark):
    """Build raw tables from rows given as dicts; missing tables and columns are empty."""
    def make(**rows):
        return {
            name: spark.createDataFrame(
                [tuple(r.get(f.name) for f in schema) for r in rows.get(name, [])], schema).coalesce(1)
            for name, schema in RAW_SCHEMAS.items()}
    return make
