import datetime as dt
import json
import os
import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

from tidewatch.contracts import KAFKA_SCHEMA  # noqa: E402

SF = "/root/testdata/sf0.001"

EVENT = {
    "event_id": "1",
    "symbol": "AAPL",
    "company": "Fruit Co",
    "price": 64.25,
    "volume": 8200,
    "change": -0.5,
    "change_percent": -0.77,
    "timestamp": "2026-06-25T14:30:00Z",
    "exchange": "NASDAQ",
}


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf():
    return SF


@pytest.fixture(scope="session")
def bus(spark):
    """Bus records from payloads: dicts, texts or bytes."""

    def make(*payloads, topic="events"):
        rows = []
        for i, payload in enumerate(payloads):
            if isinstance(payload, dict):
                payload = json.dumps(payload)
            if isinstance(payload, str):
                payload = payload.encode()
            rows.append((None, payload, topic, 0, i, None))
        return spark.createDataFrame(rows, KAFKA_SCHEMA)

    return make


@pytest.fixture(scope="session")
def event():
    """A valid event, with changes; a field set to Ellipsis is left out."""

    def make(**changes):
        return {k: v for k, v in (EVENT | changes).items() if v is not ...}

    return make


@pytest.fixture
def feed(spark, event, tmp_path):
    """A landing folder for text files; each call lands one file, in order."""
    folder = tmp_path / "feed"
    folder.mkdir()
    landed = []

    def land(*rows):
        lines = []
        for event_id, second, changes in rows:
            stamp = dt.datetime(2026, 6, 25) + dt.timedelta(seconds=second)
            given = event(event_id=event_id, timestamp=stamp.isoformat() + "Z", **changes)
            lines.append(json.dumps(given))
        path = folder / f"{len(landed):03d}.txt"
        path.write_text("\n".join(lines) + "\n")
        os.utime(path, (1_700_000_000 + len(landed),) * 2)
        landed.append(path)
        return str(folder)

    return land
