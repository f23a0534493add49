import os
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
for folder in (ROOT, ROOT / "tests"):
    sys.path.insert(0, str(folder))
os.environ["PYTHONPATH"] = os.pathsep.join(filter(None, [str(ROOT), os.environ.get("PYTHONPATH")]))


@pytest.fixture(scope="session")
def spark():
    from gridspark.session import local_session

    session = local_session()
    yield session
    session.stop()


@pytest.fixture
def rows():
    """Collect a DataFrame as tuples of the named columns, sorted."""

    def collect(df, *columns):
        return sorted((tuple(row) for row in df.select(*columns).collect()), key=repr)

    return collect


@pytest.fixture
def small_splits(spark):
    """Splits of a few dozen bytes, so that small fixtures take the large-file route."""
    keys = {"spark.sql.files.maxPartitionBytes": "64", "spark.sql.files.openCostInBytes": "1"}
    before = {key: spark.conf.get(key, None) for key in keys}
    for key, value in keys.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)
