import json
import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.join(os.path.dirname(os.path.abspath(__file__)), ".."))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def write_lines(tmp_path):
    """Write JSON values, one per line, to a new file and return its folder."""

    def write(folder: str, values: list, name: str = "part.json") -> str:
        target = tmp_path / folder
        target.mkdir(parents=True, exist_ok=True)
        (target / name).write_text("".join(json.dumps(v) + "\n" for v in values))
        return str(target)

    return write


def rows(df, *order):
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
