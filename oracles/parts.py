"""The flights projection in DuckDB SQL, and small text helpers for the oracles."""

from __future__ import annotations

# The carrier codes, carrier names and cause labels in it are fixed values.
FLIGHTS = """
WITH keyed AS (
    SELECT li.*,
        31 * l_orderkey + 17 * l_partkey + 13 * l_suppkey + 7 * l_linenumber::BIGINT
            + 101 * l_quantity::BIGINT AS h,
        l_shipdate::DATE AS flight_date,
        s.s_nationkey AS okey, c.c_nationkey AS dkey
    FROM lineitem li
    LEFT JOIN supplier s ON s.s_suppkey = li.l_suppkey
    LEFT JOIN orders o ON o.o_orderkey = li.l_orderkey
    LEFT JOIN customer c ON c.c_custkey = o.o_custkey
), departed AS (
    SELECT *,
        h % 24 AS hh, (h // 24) % 60 AS mi,
        CASE WHEN h % 41 <> 0
             THEN (h // 7) % 60 - 40 + h % 24 + CASE WHEN h % 53 = 0 THEN 150 ELSE 0 END END AS dep
    FROM keyed
), landed AS (
    SELECT *,
        CASE WHEN h % 97 <> 0 THEN dep + h % 31 - 15 END AS arr,
        (hh * 60 + mi + dep + 1440) % 1440 AS out_min,
        (hh * 60 + mi + 40 + h % 200) % 1440 AS due_min
    FROM departed
), caused AS (
    SELECT *,
        (out_min + 40 + h % 200) % 1440 AS in_min,
        CASE WHEN arr >= 15 THEN
            CASE WHEN h % 89 = 0 THEN 0 WHEN h % 7 = 0 THEN arr // 2 ELSE arr - arr // 3 END
        END AS big,
        CASE WHEN arr >= 15 THEN
            CASE WHEN h % 89 = 0 THEN 0 WHEN h % 7 = 0 THEN arr // 2 ELSE arr // 3 END
        END AS small
    FROM landed
), base AS (
    SELECT
        year(flight_date)::INTEGER AS "year", month(flight_date)::INTEGER AS "month",
        day(flight_date)::INTEGER AS day_of_month, isodow(flight_date)::INTEGER AS day_of_week,
        flight_date,
        (['9E','AA','AS','B6','DL','F9','G4','HA','MQ','NK','OH','OO','UA','WN','YX','ZZ'])
            [l_suppkey % 16 + 1] AS carrier_code,
        'N' || lpad(okey::VARCHAR, 2, '0') AS origin, 'City ' || okey AS origin_city,
        'S' || (okey % 5) AS origin_state,
        'N' || lpad(dkey::VARCHAR, 2, '0') AS dest, 'City ' || dkey AS dest_city,
        'S' || (dkey % 5) AS dest_state,
        (hh * 100 + mi)::DOUBLE AS crs_dep_time,
        (out_min // 60 * 100 + out_min % 60)::DOUBLE AS dep_time,
        dep::DOUBLE AS dep_delay,
        CASE WHEN dep < 0 THEN 0 ELSE dep END::DOUBLE AS dep_delay_minutes,
        (due_min // 60 * 100 + due_min % 60)::DOUBLE AS crs_arr_time,
        CASE WHEN arr IS NOT NULL THEN in_min // 60 * 100 + in_min % 60 END::DOUBLE AS arr_time,
        arr::DOUBLE AS arr_delay,
        CASE WHEN arr < 0 THEN 0 ELSE arr END::DOUBLE AS arr_delay_minutes,
        CASE WHEN h % 41 = 0 THEN 1 ELSE 0 END::INTEGER AS cancelled,
        CASE WHEN h % 41 = 0 THEN substr('ABCD', ((h // 41) % 4 + 1)::INTEGER, 1) END
            AS cancellation_code,
        (200 + h % 2400)::DOUBLE AS distance,
        (CASE h % 5 WHEN 0 THEN big WHEN 3 THEN small ELSE 0 * big END)::DOUBLE AS carrier_delay,
        (CASE h % 5 WHEN 1 THEN big WHEN 4 THEN small ELSE 0 * big END)::DOUBLE AS weather_delay,
        (CASE h % 5 WHEN 2 THEN big WHEN 0 THEN small ELSE 0 * big END)::DOUBLE AS nas_delay,
        (CASE h % 5 WHEN 3 THEN big WHEN 1 THEN small ELSE 0 * big END)::DOUBLE AS security_delay,
        (CASE h % 5 WHEN 4 THEN big WHEN 2 THEN small ELSE 0 * big END)::DOUBLE
            AS late_aircraft_delay
    FROM caused
), flights AS (
    SELECT *,
        CASE WHEN arr_delay >= 15 THEN 1 WHEN arr_delay < 15 THEN 0 END::INTEGER AS arr_del15,
        CASE WHEN dep_delay >= 15 THEN 1 WHEN dep_delay < 15 THEN 0 END::INTEGER AS dep_del15,
        LEAST(23, GREATEST(0, floor(crs_dep_time / 100)))::INTEGER AS hour_of_day,
        CASE WHEN day_of_week >= 6 THEN 1 ELSE 0 END::INTEGER AS is_weekend,
        origin || '-' || dest AS route,
        quarter(flight_date)::INTEGER AS "quarter",
        CASE WHEN cancelled = 0 AND arr_delay >= 15 THEN 1 ELSE 0 END::INTEGER AS is_delayed,
        CASE WHEN arr_delay >= 15 AND carrier_delay + weather_delay + nas_delay
                + security_delay + late_aircraft_delay > 0
            THEN list_extract(['Carrier', 'Weather', 'NAS', 'Security', 'Late Aircraft'],
                list_position(
                    [carrier_delay, weather_delay, nas_delay, security_delay, late_aircraft_delay],
                    GREATEST(carrier_delay, weather_delay, nas_delay, security_delay,
                             late_aircraft_delay))::BIGINT)
        END AS primary_delay_cause
    FROM base
), dim_airports AS (
    SELECT 'N' || lpad(n_nationkey::VARCHAR, 2, '0') AS iata_code, n_name AS airport_name,
        (25 + n_nationkey)::DOUBLE AS latitude, (3 * n_nationkey - 128)::DOUBLE AS longitude,
        'XX' AS iso_country, r_name AS iso_region, n_name AS city, 'hub' AS airport_type
    FROM nation JOIN region ON r_regionkey = n_regionkey
    WHERE n_nationkey <= 23
), dim_carriers AS (
    SELECT * FROM (VALUES
        ('9E', 'Endeavor Air'), ('AA', 'American Airlines'), ('AS', 'Alaska Airlines'),
        ('B6', 'JetBlue Airways'), ('DL', 'Delta Air Lines'), ('F9', 'Frontier Airlines'),
        ('G4', 'Allegiant Air'), ('HA', 'Hawaiian Airlines'), ('MQ', 'Envoy Air'),
        ('NK', 'Spirit Airlines'), ('OH', 'PSA Airlines'), ('OO', 'SkyWest Airlines'),
        ('UA', 'United Airlines'), ('WN', 'Southwest Airlines'), ('YX', 'Republic Airways')
    ) AS names(carrier_code, carrier_name)
), dim_calendar AS (
    SELECT DISTINCT flight_date, "year", "quarter", "month", day_of_month, day_of_week, is_weekend,
        CASE WHEN "month" IN (12, 1, 2) THEN 'Winter' WHEN "month" <= 5 THEN 'Spring'
             WHEN "month" <= 8 THEN 'Summer' ELSE 'Fall' END AS season
    FROM flights
)
"""


def over_flights(query: str) -> str:
    """A query over the flights projection; it may add its own ``, name AS (...)`` parts first."""
    return FLIGHTS + query


def rnd(expr: str, digits: int = 2) -> str:
    """ROUND without a negative zero."""
    return f"(ROUND({expr}, {digits}) + 0e0)"


def share(condition: str, digits: int = 2) -> str:
    """Percentage of all rows in scope that meet the condition."""
    return rnd(f"100e0 * AVG(CASE WHEN {condition} THEN 1e0 ELSE 0e0 END)", digits)


def pct(numerator: str, denominator: str = "COUNT(*)", digits: int = 2) -> str:
    return rnd(f"100e0 * ({numerator}) / NULLIF({denominator}, 0)", digits)


LATE15 = "arr_del15 = 1"
POSITIVE_AVG = rnd("AVG(arr_delay_minutes) FILTER (WHERE arr_delay_minutes > 0)")
DELAY_FLAG_PCT = pct("SUM(is_delayed)")
ON_TIME_PCT = pct("COUNT(*) FILTER (WHERE is_delayed = 0 AND cancelled = 0)")
