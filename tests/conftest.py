import contextlib
import io
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from wattledger.session import build_session  # noqa: E402

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    work = tmp_path_factory.mktemp("spark")
    session = build_session(
        "tests",
        "local[8]",
        **{
            "spark.driver.memory": "8g",
            "spark.sql.shuffle.partitions": "8",
            "spark.sql.warehouse.dir": str(work / "warehouse"),
            "spark.checkpoint.dir": str(work / "checkpoint"),
        },
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture
def settings(spark):
    """Sets session options for one test."""
    before = {}

    def apply(**options):
        for key, value in options.items():
            key = key.replace("__", ".")
            before.setdefault(key, spark.conf.get(key, None))
            spark.conf.set(key, value)

    yield apply
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def plan_text(frame, mode="formatted"):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        frame.explain(mode)
    return out.getvalue()
