from __future__ import annotations

from datetime import datetime, timedelta

import pytest
from pyspark.sql import DataFrame, SparkSession

from tidelog import ENVELOPE, configured, scratch_path

START = datetime(2024, 1, 1)


@pytest.fixture(scope="session")
def spark() -> SparkSession:
    builder = (
        SparkSession.builder.master("local[8]")
        .appName("tidelog-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.driver.memory", "4g")
    )
    session = configured(builder).getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture
def path(spark):
    """Fresh folder names in the scratch storage."""
    return lambda name: scratch_path(spark, f"test-{name}")


@pytest.fixture
def messages(spark):
    """Envelope rows from ``(id, topic, payload)``, one second apart."""

    def build(rows: list[tuple]) -> DataFrame:
        filled = []
        for position, (id_, topic, payload) in enumerate(rows):
            raw = payload.encode() if isinstance(payload, str) else payload
            filled.append((id_, topic, None if raw is None else bytearray(raw), START + timedelta(seconds=position)))
        return spark.createDataFrame(filled, ENVELOPE).coalesce(1)

    return build


def payloads(frame: DataFrame) -> list[str]:
    return sorted(bytes(row["payload"]).decode() for row in frame.select("payload").collect())
