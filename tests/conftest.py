import tempfile

import pytest

from tarmac.plans.data import Data
from tarmac.session import build_session

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tarmac-tests",
        "local[4]",
        spark__sql__shuffle__partitions="4",
        spark__driver__memory="4g",
        spark__sql__maxMetadataStringLength="5000",  # plans are inspected
        spark__ui__showConsoleProgress="false",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def data(spark):
    return Data(spark, SF_DIR)


@pytest.fixture
def folder():
    return tempfile.mkdtemp(prefix="tarmac-test-")


FLIGHT_DEFAULTS = {
    "id": 1, "flight_date": "2023-01-01", "airline_code": "AA", "flight_number": "1",
    "origin": "JFK", "destination": "LAX", "dep_time": "08:00:00", "dep_delay_min": 0,
    "arr_time": "11:00:00", "arr_delay_min": 0, "cancelled": False, "diverted": False,
    "distance_miles": 100, "carrier_delay": None, "weather_delay": None, "nas_delay": None,
    "security_delay": None, "late_aircraft_delay": None,
}
TYPES = {
    "id": "bigint", "flight_date": "date", "dep_delay_min": "int", "arr_delay_min": "int",
    "cancelled": "boolean", "diverted": "boolean", "distance_miles": "int",
    "carrier_delay": "int", "weather_delay": "int", "nas_delay": "int",
    "security_delay": "int", "late_aircraft_delay": "int",
}


@pytest.fixture
def flights_of(spark):
    """Build flights from partial rows; everything not given has a harmless default."""

    def build(*rows: dict):
        full = [
            tuple(None if v is None else str(v) for v in {**FLIGHT_DEFAULTS, "id": i, **row}.values())
            for i, row in enumerate(rows)
        ]
        text = spark.createDataFrame(full, ", ".join(f"{c} string" for c in FLIGHT_DEFAULTS))
        return text.selectExpr(*[f"CAST({c} AS {TYPES.get(c, 'string')}) AS {c}" for c in FLIGHT_DEFAULTS])

    return build


def rows(df):
    return [tuple(r) for r in df.collect()]
