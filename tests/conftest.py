import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .appName("skytally-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "4g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def fixture_folder(tmp_path_factory):
    from fixture_data import write_fixture

    return write_fixture(tmp_path_factory.mktemp("flights"))


@pytest.fixture(scope="session")
def fixture_flights(spark, fixture_folder):
    from skytally import load_flights

    return load_flights(spark, fixture_folder)


@pytest.fixture(scope="session")
def make_flights(spark):
    """Flights from dictionaries; columns left out are null."""
    from datetime import date

    from skytally.sources import FLIGHT_SCHEMA

    def make(*rows):
        filled = [{"FL_DATE": date(2017, 1, 1), "CANCELLED": 0.0} | row for row in rows]
        return spark.createDataFrame([tuple(r.get(c) for c in FLIGHT_SCHEMA.names) for r in filled], FLIGHT_SCHEMA)

    return make
