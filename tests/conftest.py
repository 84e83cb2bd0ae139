import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from sparkmon.session import get_session

    scratch = str(tmp_path_factory.mktemp("shared"))
    session = get_session(
        "tests",
        master="local[8]",
        shuffle_partitions=4,
        conf={"spark.checkpoint.dir": scratch, "spark.driver.memory": "4g"},
    )
    yield session
    session.stop()


@pytest.fixture(scope="session")
def folder():
    return SF_SMALL


@pytest.fixture(scope="session")
def events(spark, folder):
    from sparkmon.plans.telemetry import telemetry

    return telemetry(spark.read.parquet(f"{folder}/events.parquet")).persist()


@pytest.fixture(scope="session")
def guides(spark):
    from sparkmon.sources.files import packaged_guides

    return packaged_guides(spark)


@pytest.fixture
def alert(spark):
    """Builds an alert frame from overrides of one reading."""
    base = {
        "event_id": "a",
        "event_time": "2024-01-01 00:00:00",
        "site": "Zurich",
        "machine_id": "M-1",
        "machine_type": "CNC_Mill",
        "temperature_c": 97.5,
        "vibration_mm_s": 2.9,
        "spindle_load_pct": 88.0,
        "power_kw": 36.5,
        "acoustic_db": 79.0,
        "anomaly_prob": 0.95,
    }
    types = ", ".join(
        f"{k} {'double' if isinstance(v, float) else 'string'}" for k, v in base.items()
    )

    def build(*overrides):
        rows = [{"event_id": str(i)} | o for i, o in enumerate(overrides)]
        return spark.createDataFrame([tuple((base | r).values()) for r in rows], types)

    return build
