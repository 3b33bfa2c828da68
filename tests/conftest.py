import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from metricmart.session import get_spark  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = get_spark(
        "tests", "local[4]",
        **{"spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
           "spark.driver.memory": "4g", "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse"))},
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session


@pytest.fixture
def rows():
    """Collect a frame as a sorted list of dicts."""

    def collect(df):
        return sorted((r.asDict(recursive=True) for r in df.collect()), key=lambda d: str(sorted(d.items(), key=str)))

    return collect
