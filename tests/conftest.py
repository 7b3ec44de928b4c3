import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from silvertide.session import local_session  # noqa: E402

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    session = local_session("tests", "8", "8g")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return DATA


@pytest.fixture(scope="session")
def layers(spark, sf_dir):
    from contract.gold import layers as build

    return build(spark, sf_dir)


@pytest.fixture
def one(spark):
    """Value of an expression over a one-column frame of the given values."""

    def evaluate(values, build, kind="string"):
        df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
        return [r[1] for r in df.select("i", build("v").alias("r")).orderBy("i").collect()]

    return evaluate
