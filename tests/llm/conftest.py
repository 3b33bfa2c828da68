import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
from metricmart.llm.common import Scratch  # noqa: E402


@pytest.fixture
def scratch(spark):
    with Scratch(spark) as one:
        yield one


@pytest.fixture
def docs(spark):
    """Documents with a column that has the name of an operator's own."""

    def make(rows, extra="kept"):
        full = [(i, t, lang, source, "x") for i, t, lang, source in [(*r, *([None] * (4 - len(r)))) for r in rows]]
        return spark.createDataFrame(full, f"doc_id long, text string, lang string, source string, `{extra}` string").repartition(3)

    return make
