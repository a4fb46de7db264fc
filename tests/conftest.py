from __future__ import annotations

import sys
from pathlib import Path

import pytest

HERE = Path(__file__).resolve().parent
sys.path[:0] = [str(HERE.parent), str(HERE)]

from wardline.session import build_session  # noqa: E402

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "wardline-tests",
        master="local[4]",
        shuffle_partitions=4,
        **{
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "4g",
            "spark.sql.debug.maxToStringFields": "1000",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def data() -> str:
    return DATA


def plan_text(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


PYTHON_NODES = (
    "BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroupsInPandas",
    "PythonMapInArrow", "AggregateInPandas",
)


def record(**fields) -> dict:
    """A neutral record: zeros and "none", labelled normal."""
    from wardline.schema import RECORD_SCHEMA

    blank = {"double": 0.0, "integer": 0, "string": "none"}
    row = {f.name: blank[f.dataType.typeName()] for f in RECORD_SCHEMA.fields}
    return {**row, "label": "normal", **fields}
