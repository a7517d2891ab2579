import os
import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from marketlake.session import ENGINE_SETTINGS  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .appName("marketlake-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.driver.memory", "4g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("checkpoint")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def started_with(spark):
    return {key: spark.conf.get(key, None) for key in ENGINE_SETTINGS}


@pytest.fixture(autouse=True)
def own_settings(request):
    """Queries leave the engine's settings set, because their results are lazy; no test passes them on to the next."""
    if "spark" not in request.fixturenames:
        yield
        return
    spark, started = request.getfixturevalue("spark"), request.getfixturevalue("started_with")
    yield
    for key, value in started.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


@pytest.fixture(scope="session")
def sf_dir():
    path = "/root/testdata/sf0.001"
    if not os.path.isdir(path):
        pytest.skip("no test tables")
    return path


@pytest.fixture
def rows():
    """Rows of a frame as a sorted list of tuples."""

    def collect(df, *columns):
        selected = df.select(*columns) if columns else df
        return sorted((tuple(r) for r in selected.collect()), key=repr)

    return collect
