from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from lotwise.session import local_session  # noqa: E402

TESTDATA = Path("/root/testdata")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(4, 4, **{"spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared"))})
    yield session
    session.stop()


@pytest.fixture(scope="session")
def small_sf():
    path = TESTDATA / "sf0.001"
    if not path.exists():
        pytest.skip("driver tables are not available")
    return str(path)


@pytest.fixture
def column(spark):
    """Evaluate a Column function over a list of texts."""

    def run(function, values, dtype="string"):
        from pyspark.sql import functions as F

        rows = [(i, value) for i, value in enumerate(values)]
        df = spark.createDataFrame(rows, f"i int, v {dtype}")
        return [row.r for row in df.select("i", function(F.col("v")).alias("r")).orderBy("i").collect()]

    return run
