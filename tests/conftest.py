import os

import pytest

os.environ.setdefault("SPARK_LOCAL_IP", "127.0.0.1")

from tallyworks.session import build_session, shared_dir

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests", "local[*]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false", spark__driver__memory="6g",
    )
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture
def folder(spark):
    """A new folder in the shared place jobs write to."""
    return shared_dir(spark, "test")


@pytest.fixture
def database(spark):
    from tallyworks.plans.warehouse import create_star_schema
    from tallyworks.registry.queries import _database

    name = _database(spark)
    create_star_schema(spark, name)
    return name


@pytest.fixture
def lines(spark):
    """Write lines of text as one file of a folder and return the folder."""

    def write(path, rows, **options):
        frame = spark.createDataFrame([(r,) for r in rows], "value string").coalesce(1)
        frame.write.mode("append").options(**options).text(path)
        return path

    return write
