import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

from lodestone.session import local_session  # noqa: E402
from lodestone.sources.catalog import RELATION_SCHEMAS, catalog_from  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"
CONNECTION = "default/mysql/harbour-7"


@pytest.fixture(scope="session")
def spark():
    session = local_session("tests", cpus=4)
    yield session
    session.stop()


@pytest.fixture
def conf(spark):
    """Set session settings for one test."""
    before = {}

    def set_conf(**values):
        for key, value in values.items():
            key = key.replace("__", ".")
            before.setdefault(key, spark.conf.get(key, None))
            spark.conf.set(key, value)

    yield set_conf
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


@pytest.fixture
def make_catalog(spark):
    """A catalog of literal rows: relation -> list of dicts; unnamed columns are NULL."""

    def make(connection=CONNECTION, **rows):
        frames = {}
        for name, schema in RELATION_SCHEMAS.items():
            given = rows.get(name, [{}] if name == "connections" else [])
            frames[name] = spark.createDataFrame(
                [tuple({"connection_qn": connection, **row}.get(f, None) for f in schema.fieldNames()) for row in given],
                schema,
            )
        return catalog_from(frames)

    return make


@pytest.fixture
def frame(spark):
    def make(ddl, *rows):
        return spark.createDataFrame(list(rows), ddl)

    return make
