import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

from shelfmend.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    return local_session(8)


@pytest.fixture
def frame(spark):
    """``frame("a int, b string", (1, "x"), …)``"""

    def make(schema: str, *rows: tuple):
        return spark.createDataFrame(list(rows), schema)

    return make


@pytest.fixture
def settings(spark):
    """Set SQL settings for one test."""
    before = {}

    def put(**values):
        for key, value in values.items():
            name = key.replace("__", ".")
            before.setdefault(name, spark.conf.get(name, None))
            spark.conf.set(name, value)

    yield put
    for name, value in before.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


@pytest.fixture
def settings_of(settings):
    """The same under a name that does not clash with that of a test's property settings."""
    return settings


@pytest.fixture
def bag():
    def collect(df, *columns):
        return sorted((tuple(r) for r in df.select(*(columns or df.columns)).collect()), key=repr)

    return collect
