import os
import sys
from contextlib import contextmanager

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from ledgerloom.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[*]",
        partitions=8,
        settings={
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "6g",
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture
def new_path(tmp_path):
    """Paths below a fresh folder; nothing is created at them."""
    return lambda name: str(tmp_path / name)


@pytest.fixture
def settings(spark):
    """Session settings that hold inside a ``with`` block."""

    @contextmanager
    def held(**values):
        values = {name.replace("__", "."): value for name, value in values.items()}
        before = {name: spark.conf.get(name, None) for name in values}
        for name, value in values.items():
            spark.conf.set(name, value)
        try:
            yield
        finally:
            for name, value in before.items():
                spark.conf.unset(name) if value is None else spark.conf.set(name, value)

    return held
