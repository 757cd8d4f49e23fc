from __future__ import annotations

import datetime as dt
import gzip

import pytest

from skyledger.functions.fixed_values import RAW_TO_COLUMN
from skyledger.plans import exports, quality, rollups
from skyledger.session import run_sql
from skyledger.sources import raw_flights
from skyledger.sources.dimensions import airports_from_csv, calendar_dimension, carrier_dimension
from skyledger.sources.schema import FLIGHTS_SCHEMA
from skyledger.sources.sinks import read_flights, replace_months, write_flights, write_table
from tests.conftest import rows_of


def test_flags_are_three_valued(make_flights):
    flights = make_flights(
        [
            {"arr_delay": 14, "distance": 1},
            {"arr_delay": 15, "distance": 2},
            {"cancelled": 1, "distance": 3},
            {"distance": 4},
        ]
    )
    rows = rows_of(flights.orderBy("distance").select("arr_del15", "is_delayed"))
    assert rows == [(0, 0), (1, 1), (None, 0), (None, 0)]


def test_hour_is_clipped(make_flights):
    times = [0, 59, 1430, 2359, 2400, None]
    flights = make_flights([{"crs_dep_time": t, "distance": i} for i, t in enumerate(times)])
    hours = [h for (h,) in rows_of(flights.orderBy("distance").select("hour_of_day"))]
    assert hours == [0, 0, 14, 23, 23, None]


def test_primary_cause(make_flights):
    names = ["carrier_delay", "weather_delay", "nas_delay", "security_delay", "late_aircraft_delay"]

    def flight(i, delay, causes):
        return {"arr_delay": delay, "distance": i} | dict(zip(names, causes, strict=True))

    flights = make_flights(
        [
            flight(0, 20, (0, 5, 5, 0, 0)),
            flight(1, 20, (None,) * 5),
            flight(2, 20, (0,) * 5),
            flight(3, 5, (9, 0, 0, 0, 0)),
            flight(4, 20, (None, None, 3, None, 8)),
        ]
    )
    causes = [c for (c,) in rows_of(flights.orderBy("distance").select("primary_delay_cause"))]
    assert causes == ["Weather", None, None, None, "Late Aircraft"]


def test_raw_csv_to_flights(spark, tmp_path):
    header = ",".join(RAW_TO_COLUMN) + ","
    lines = [
        "2023,3,1,3,3/1/2023 12:00:00 AM,DL,ATL,Atlanta,GA,LAX,Los Angeles,CA,"
        "1430,1445.0,15,15,1700,1720,20,20,0,,1946,abc,12.5,,0,7.5,",
        "2023,3,4,6,2023-03-04,AA,DFW,Dallas,TX,ATL,Atlanta,GA,2400,,,,100,,,,1.0,B,731,,,,,,",
        "2023,3,5,7,bad,AA,DFW,Dallas,TX,ATL,Atlanta,GA,x,,,,,,,,0,,731,,,,,,",
    ]
    path = tmp_path / "raw.csv"
    path.write_text("\n".join([header, *lines]) + "\n")
    flights = raw_flights.clean(raw_flights.read_raw_csv(spark, str(path)))
    assert flights.schema == FLIGHTS_SCHEMA or [
        (f.name, f.dataType) for f in flights.schema
    ] == [(f.name, f.dataType) for f in FLIGHTS_SCHEMA]
    first, second, third = flights.orderBy("day_of_month").collect()
    assert first.flight_date == dt.date(2023, 3, 1)
    assert second.flight_date == dt.date(2023, 3, 4)
    assert third.flight_date is None
    assert (first.carrier_delay, first.weather_delay, first.nas_delay) == (None, 12.5, None)
    assert first.primary_delay_cause == "Weather"
    assert (first.route, first.is_weekend, first.quarter) == ("ATL-LAX", 0, 1)
    assert (second.cancelled, second.cancellation_code, second.hour_of_day) == (1, "B", 23)
    assert (second.is_weekend, third.hour_of_day) == (1, None)


def test_missing_columns_become_nulls(spark):
    raw = spark.createDataFrame([("2023", "DL")], "YEAR string, OP_UNIQUE_CARRIER string")
    (row,) = raw_flights.clean(raw).collect()
    assert (row.year, row.carrier_code, row.carrier_delay, row.flight_date) == (
        2023, "DL", None, None,
    )


def test_numbers_that_do_not_parse(spark):
    raw = spark.createDataFrame(
        [("12",), ("12.5",), ("abc",), ("",), ("NaN",)], "DISTANCE string"
    )
    values = [r.distance for r in raw_flights.clean(raw).collect()]
    assert values == [12.0, 12.5, None, None, None]


def test_airports_csv(spark, tmp_path):
    path = tmp_path / "airports.csv"
    path.write_text(
        '"id","iata_code","name","latitude_deg","longitude_deg","iso_country","iso_region",'
        '"municipality","type"\n'
        '1,"ATL","Hartsfield, Atlanta",33.6,-84.4,"US","US-GA","Atlanta","large_airport"\n'
        '2,"","Nowhere",1,2,"US","US-GA","None","small_airport"\n'
        '3,"  ","Blank",1,2,"US","US-GA","None","small_airport"\n'
    )
    (row,) = airports_from_csv(spark, str(path)).collect()
    assert (row.iata_code, row.airport_name, row.latitude) == ("ATL", "Hartsfield, Atlanta", 33.6)


def test_dimensions(make_flights, carriers):
    flights = make_flights(
        [
            {"carrier_code": "DL", "flight_date": dt.date(2023, 1, 7)},
            {"carrier_code": "DL", "flight_date": dt.date(2023, 1, 7)},
            {"carrier_code": "ZZ", "flight_date": dt.date(2023, 10, 2)},
        ]
    )
    counts = {r.carrier_code: r.total_flights for r in carrier_dimension(flights, carriers).collect()}
    assert len(counts) == 15 and counts["DL"] == 2 and counts["AA"] == 0
    days = calendar_dimension(flights).collect()
    assert [(d.season, d.is_weekend) for d in days] == [("Winter", 1), ("Fall", 0)]


def test_write_and_read_back(spark, make_flights, carriers, tmp_path):
    flights = make_flights(
        [
            {"flight_date": dt.date(2023, m, 1), "carrier_code": "DL", "arr_delay": m,
             "crs_dep_time": 900, "origin": "ATL", "dest": "LAX"}
            for m in (1, 2, 2)
        ]
    )
    path = str(tmp_path / "flights")
    write_flights(flights, path)
    back = read_flights(spark, path, view="flights")
    assert sorted(p.name for p in (tmp_path / "flights" / "year=2023").iterdir()) == [
        "month=1", "month=2",
    ]
    assert sorted(rows_of(back.select(*flights.columns)), key=str) == sorted(
        rows_of(flights), key=str
    )
    capped = run_sql(
        spark, "SELECT month, arr_delay FROM flights WHERE month = :m", {"m": 2}, max_rows=1
    )
    assert rows_of(capped) == [(2, 2.0)]
    names = rollups.install_tables(spark, flights=back, dim_carriers=carriers)
    assert {"flights", "dim_carriers"} <= set(names)
    assert rollups.install_views(back, carriers) == [
        "v_daily_airport_summary", "v_monthly_carrier_performance", "v_route_reliability",
    ]
    assert spark.table("v_daily_airport_summary").count() == 2
    assert quality.column_names(back) == [f.name for f in FLIGHTS_SCHEMA]


def test_exports(spark, make_flights, carriers, tmp_path):
    airports = spark.createDataFrame(
        [("ATL", "Atlanta", 33.0, -84.0, "US", "GA", "Atlanta", "large")],
        "iata_code string, airport_name string, latitude double, longitude double,"
        " iso_country string, iso_region string, city string, airport_type string",
    )
    flights = make_flights(
        [{"carrier_code": "DL", "origin": "ATL", "flight_date": dt.date(2023, 1, 1),
          "arr_delay": 30, "crs_dep_time": 900}]
    )
    with pytest.raises(ValueError, match="airports.*carriers.*hourly"):
        exports.dataset("nope", flights, carriers, airports)
    csv = str(tmp_path / "carriers")
    exports.export_dataset("carriers", csv, flights, carriers, airports)
    (row,) = spark.read.csv(csv, header=True).collect()
    assert (row.carrier_code, row.delay_pct) == ("DL", "100.0")
    json = str(tmp_path / "hourly")
    exports.export_dataset("hourly", json, flights, carriers, airports, "json")
    (row,) = spark.read.json(json).collect()
    assert (row.hour, row.delay_rate) == (9, 100.0)
    paths = exports.export_report(str(tmp_path / "report"), flights, carriers, airports)
    assert len(paths) == 6
    summary = spark.read.csv(paths[0], header=True)
    assert summary.count() == 13
    with pytest.raises(ValueError, match="Unknown format"):
        write_table(flights, str(tmp_path / "x"), "xlsx")


def test_headers_are_read_without_a_job(spark, tmp_path):
    known = list(RAW_TO_COLUMN)[:4]
    (tmp_path / "a b%20c.csv").write_text(",".join(known) + "\r\n1,2,3,4\r\n" + "5,6,7,8\r\n" * 50_000)
    with gzip.open(tmp_path / "b.csv.gz", "wt") as out:
        out.write(",".join(reversed(known)) + "\n9,8,7,6\n")
    (tmp_path / "empty.csv").write_text("")
    sc = spark.sparkContext
    sc.setJobGroup("headers", "headers")
    raw = raw_flights.read_raw_csv(spark, str(tmp_path))
    jobs = sc.statusTracker().getJobIdsForGroup("headers")
    sc.setLocalProperty("spark.jobGroup.id", None)
    assert not jobs
    rows = {tuple(r) for r in raw.select(*known).distinct().collect()}
    assert rows == {("1", "2", "3", "4"), ("5", "6", "7", "8"), ("6", "7", "8", "9")}


def test_only_the_months_loaded_are_replaced(make_flights, spark, tmp_path):
    path = tmp_path / "flights"
    days = [dt.date(2023, m, d) for m in (1, 2, 3) for d in (1, 2)]
    write_flights(make_flights([{"flight_date": d, "distance": 1} for d in days]), str(path))
    files = lambda m: sorted(p.name for p in path.glob(f"year=2023/month={m}/*.parquet"))
    before = {m: files(m) for m in (1, 2, 3)}
    replace_months(make_flights([{"flight_date": days[2], "distance": 5}, {"flight_date": dt.date(2024, 2, 1), "distance": 7}]), str(path))
    assert all(files(m) == before[m] for m in (1, 3)) and files(2) != before[2]
    found = rows_of(read_flights(spark, str(path)).select("year", "month", "distance"))
    assert sorted(found) == [(2023, 1, 1.0)] * 2 + [(2023, 2, 5.0)] + [(2023, 3, 1.0)] * 2 + [(2024, 2, 7.0)]
