from __future__ import annotations

import pytest

from skyledger.session import get_session
from skyledger.sources.dimensions import carrier_names
from skyledger.sources.raw_flights import derive
from skyledger.sources.schema import SOURCE_COLUMNS
from pyspark.sql.types import StructField, StructType

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = get_session(
        "tests",
        "local[4]",
        4,
        **{
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "6g",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    if not session.conf.get("spark.checkpoint.dir", None):
        session.conf.set("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
    yield session
    session.stop()


@pytest.fixture(scope="session")
def carriers(spark):
    return carrier_names(spark)


@pytest.fixture(scope="session")
def make_flights(spark):
    """Flights from dicts: anything left out is null, apart from ``cancelled``."""
    schema = StructType([StructField(n, k) for n, k in SOURCE_COLUMNS.items()])

    def build(rows):
        filled = []
        for row in rows:
            row = {"cancelled": 0} | row
            day = row.get("flight_date")
            if day:
                row = {
                    "year": day.year,
                    "month": day.month,
                    "day_of_month": day.day,
                    "day_of_week": day.isoweekday(),
                } | row
            for side in ("arr", "dep"):
                delay = row.get(f"{side}_delay")
                if delay is not None:
                    row = {f"{side}_delay_minutes": max(delay, 0)} | row
            filled.append(
                tuple(
                    float(v) if v is not None and kind.typeName() == "double" else v
                    for n, kind in SOURCE_COLUMNS.items()
                    for v in [row.get(n)]
                )
            )
        return derive(spark.createDataFrame(filled, schema))

    return build


def rows_of(df):
    return [tuple(row) for row in df.collect()]
