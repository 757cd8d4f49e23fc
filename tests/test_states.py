from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from skyledger.plans import rollups, states
from skyledger.sources.driver_tables import DriverTables
from tests.conftest import SMALL


@pytest.fixture(scope="module")
def flights(spark):
    return DriverTables(spark, SMALL).flights


def same(a, b):
    assert sorted(a.columns) == sorted(b.columns)
    rows = lambda df: sorted(map(str, df.select(*sorted(df.columns)).collect()))
    assert rows(a) == rows(b) != []


def all_same(spark, path, flights, carriers):
    same(states.daily_airport_summary(spark, path), rollups.daily_airport_summary(flights))
    same(states.monthly_carrier_performance(spark, path, carriers),
         rollups.monthly_carrier_performance(flights, carriers))
    same(states.route_reliability(spark, path, 3), rollups.route_reliability(flights, 3))


def test_parts_of_months_merge_to_the_whole(spark, flights, carriers, tmp_path):
    path, rng = str(tmp_path / "states"), random.Random(1)
    cut = rng.randrange(1000)
    part = F.pmod(F.xxhash64(*flights.columns), F.lit(1000)) < cut
    states.load(flights.where(part), path, add=True)
    states.load(flights.where(~part), path, add=True)
    all_same(spark, path, flights, carriers)


def test_loading_a_month_again_changes_its_folders_alone(spark, flights, carriers, tmp_path):
    path = tmp_path / "states"
    states.load(flights, str(path))
    year, month = flights.select("year", "month").orderBy("year", "month").first()
    files = lambda: {p.relative_to(path) for p in path.rglob("*.parquet")}
    before, own = files(), (F.col("year") == year) & (F.col("month") == month)
    states.load(flights.where(own & (F.col("cancelled") == 0)), str(path))
    changed = {str(p.parent).split("/", 1)[1] for p in before ^ files()}
    assert changed == {f"year={year}/month={month}"}
    all_same(spark, str(path), flights.where(~own | (F.col("cancelled") == 0)), carriers)
