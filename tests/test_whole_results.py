"""Results come whole and in order: no row caps, files read by their own headers."""

from __future__ import annotations

import datetime as dt
import re

import pytest

from skyledger.operators.connections import connections
from skyledger.plans import charts, exports, questions, service
from skyledger.session import run_sql
from skyledger.sources import raw_flights
from skyledger.sources.driver_tables import DriverTables
from tests.conftest import SMALL


def months(n):
    return [dt.date(2010 + i // 12, i % 12 + 1, 5) for i in range(n)]


def test_all_months_newest_included(make_flights, carriers):
    flights = make_flights([{"flight_date": d, "arr_delay": 20} for d in months(150)])
    for rows in (service.monthly_trends(flights), exports.trends(flights, carriers, None)):
        found = [(r.year, r.month) for r in rows.collect()]
        assert found == [(d.year, d.month) for d in months(150)]
    assert service.monthly_trends(flights, max_rows=7).count() == 7


def test_unknown_hour_and_weekday_stay(make_flights):
    rows = [{"crs_dep_time": 100.0 * h, "day_of_week": h % 7 + 1} for h in range(24)]
    flights = make_flights([*rows, {"crs_dep_time": None, "day_of_week": None}])
    hours = service.delays_by_hour(flights).collect()
    assert [r.hour for r in hours] == [*range(24), None]
    days = service.day_of_week_patterns(flights).collect()
    assert [r.day_of_week for r in days] == [*range(1, 8), None]
    assert days[-1].day_name == "Unknown"
    assert sum(r.flight_count for r in service.delay_heatmap(flights).collect()) == 25


def test_all_carriers_and_airports(spark, make_flights):
    codes = [f"{i:02d}" for i in range(60)]
    names = spark.createDataFrame([(c, f"Air {c}") for c in codes], "carrier_code string, carrier_name string")
    flights = make_flights([{"carrier_code": c, "arr_delay": int(c)} for c in codes])
    for rows in (service.delays_by_carrier(flights, names), service.carrier_ranking(flights, names)):
        assert [r["rank"] for r in rows.collect()] == list(range(1, 61))
    airports = spark.createDataFrame([], "iata_code string, airport_name string")
    many = make_flights([{"origin": f"A{i:04d}", "arr_delay": i % 50} for i in range(1200)])
    assert service.airport_delays(many, airports, min_flights=1).count() == 1200
    assert service.delays_by_airport(many, airports, limit=1100, min_flights=1).count() == 1100


def test_exports_are_whole(spark, make_flights):
    codes = [f"{i:04d}" for i in range(1100)]
    names = spark.createDataFrame([(c, c) for c in codes], "carrier_code string, carrier_name string")
    flights = make_flights([{"carrier_code": c, "arr_delay": 5} for c in codes])
    assert exports.dataset("carriers", flights, names, None).count() == 1100
    assert exports.dataset("carriers", flights, names, None, max_rows=9).count() == 9
    assert questions.best_airline(flights, names, None, None).count() == 1100
    assert run_sql(spark, "SELECT * FROM range(1500)").count() == 1500


def test_files_with_other_headers(spark, tmp_path):
    (tmp_path / "a.csv").write_text("YEAR,MONTH,ORIGIN,DEST,\n2023,3,ATL,LAX,\n")
    (tmp_path / "b.csv").write_text("YEAR,MONTH,DEST,ORIGIN\n2023,4,LAX,ATL\n")
    (tmp_path / "c.csv").write_text('YEAR,ORIGIN,DEST\n2023,"ATL",LAX\n')
    flights = raw_flights.clean(raw_flights.read_raw_csv(spark, str(tmp_path)))
    found = sorted((r.year, r.month or 0, r.origin, r.dest) for r in flights.collect())
    assert found == [(2023, 0, "ATL", "LAX"), (2023, 3, "ATL", "LAX"), (2023, 4, "ATL", "LAX")]


@pytest.fixture(scope="module")
def tables(spark):
    return DriverTables(spark, SMALL)


def test_dated_connections_open_one_folder(tables):
    plan = connections(tables.flights, origin=None, date="1998-03-15")
    text = plan._jdf.queryExecution().toString()
    filters = re.findall(r"PartitionFilters: \[([^\]]*)", text)
    assert filters and all("1998" in f for f in filters)


def test_ranked_results_are_in_order(tables):
    t = tables
    for rows, measure in [
        (service.delays_by_airport(t.flights, t.airports, min_flights=10), "delay_rate"),
        (service.top_routes(t.flights, "worst", min_flights=2), "delay_rate"),
        (service.delay_causes(t.flights), "total_minutes"),
        (service.cancellations(t.flights), "count"),
        (questions.best_airline(t.flights, t.carriers, t.airports, t.calendar), "on_time_pct"),
        (questions.busiest_airport(t.flights, t.carriers, t.airports, t.calendar), "total_flights"),
        (charts.busiest_airports(t.flights), "total"),
    ]:
        values = [r[measure] for r in rows.collect()]
        assert len(values) > 2 and values == sorted(values, reverse=True)
    best = [r.delay_rate for r in service.top_routes(t.flights, "best", min_flights=2).collect()]
    assert best == sorted(best)


def test_one_scan_for_busiest_airports(tables):
    text = charts.busiest_airports(tables.flights)._jdf.queryExecution().toString()
    assert text.split("== Physical Plan ==")[1].count("FileScan") == 1


def test_changed_tables_load_anew(spark, tmp_path):
    for name in ("lineitem", "supplier", "orders", "customer"):
        spark.read.parquet(f"{SMALL}/{name}.parquet").write.parquet(f"{tmp_path}/{name}.parquet")
    t = DriverTables(spark, str(tmp_path))
    before = t.flights.count()
    spark.read.parquet(f"{SMALL}/lineitem.parquet").limit(10).write.mode("append").parquet(
        f"{tmp_path}/lineitem.parquet"
    )
    assert t.flights.count() == before + 10
