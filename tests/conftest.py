import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
sys.path.insert(0, str(Path(__file__).resolve().parent))

from builders import Staging  # noqa: E402

from punctual.plans.silver import with_event_attributes  # noqa: E402
from punctual.session import session  # noqa: E402

EVENT_SCHEMA = """trainNumber int, departureDate date, trainType string, trainCategory string,
    stationShortCode string, event_type string, commercial_stop boolean,
    scheduled_time timestamp_ntz, actual_time timestamp_ntz, delay_minutes bigint"""


@pytest.fixture(scope="session")
def spark():
    spark = session(
        "tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "2",
            "spark.default.parallelism": "2",
            # compiling takes longer than running on a few rows; the registered queries
            # are tested with code generation on
            "spark.sql.codegen.wholeStage": "false",
            "spark.sql.codegen.factoryMode": "NO_CODEGEN",
            "spark.sql.sources.parallelPartitionDiscovery.parallelism": "2",
            "spark.driver.memory": "6g",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("OFF")
    yield spark
    spark.stop()


@pytest.fixture
def fact_of(spark):
    def build(rows):
        columns = [c.split()[0] for c in EVENT_SCHEMA.split(",")]
        tuples = [tuple(r[c] for c in columns) for r in rows]
        return with_event_attributes(spark.createDataFrame(tuples, EVENT_SCHEMA))

    return build


@pytest.fixture
def staging(tmp_path):
    return Staging(tmp_path / "staging")
