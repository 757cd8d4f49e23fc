"""Oracle SQL by query name."""

from __future__ import annotations

import re

from oracles.forest import forest, permuted
from oracles.parts import (
    DELAY_FLAG_PCT,
    LATE15,
    ON_TIME_PCT,
    POSITIVE_AVG,
    over_flights,
    pct,
    rnd,
    share,
)
from skyledger.functions.fixed_values import FALLBACK_INTENT, INTENT_PATTERNS

# Causes by label.
CAUSES = {
    "Carrier": "carrier_delay",
    "Weather": "weather_delay",
    "NAS": "nas_delay",
    "Security": "security_delay",
    "Late Aircraft": "late_aircraft_delay",
}
WEEKDAY = "strftime(DATE '2024-01-01' + (day_of_week - 1)::INTEGER, '{}')"
DAY_NAME, DAY_ABBR = WEEKDAY.format("%A"), WEEKDAY.format("%a")
MONTH_ABBR = "strftime(make_date(2024, \"month\", 1), '%b')"
FLAG_RATIO = "AVG(is_delayed::DOUBLE)"


def q(at: float, value: str) -> str:
    return f"quantile_cont({value}, {at})"


def reason(code_c: str) -> str:
    return (
        "COALESCE(map(['A', 'B', 'C', 'D'], "
        f"['Carrier', 'Weather', '{code_c}', 'Security'])[cancellation_code], 'Unknown')"
    )


def each_cause(template: str, glue: str = ", ") -> str:
    return glue.join(template.format(c=c, label=label) for label, c in CAUSES.items())


def mean_of_units(value: str, digits: int, window: str = "") -> str:
    """Exact mean of rounded values, rounded to the same decimals."""
    unit = 10**digits
    whole = f"ROUND({value} * {unit})::BIGINT"
    over = f" OVER ({window})" if window else ""
    total = f"(SUM({whole}){over})::DOUBLE / (COUNT({value}){over})"
    return f"(ROUND({total}) / {unit}e0 + 0e0)"


SQL: dict[str, str] = {}

# Sources and dimensions

BASE_COLUMNS = """"year", "month", day_of_month, day_of_week, flight_date, carrier_code, origin,
    origin_city, origin_state, dest, dest_city, dest_state, crs_dep_time, dep_time, dep_delay,
    dep_delay_minutes, crs_arr_time, arr_time, arr_delay, arr_delay_minutes, cancelled,
    cancellation_code, distance, carrier_delay, weather_delay, nas_delay, security_delay,
    late_aircraft_delay"""
DERIVED_COLUMNS = """arr_del15::DOUBLE AS arr_del15, dep_del15::DOUBLE AS dep_del15,
    hour_of_day, is_weekend, route, "quarter", is_delayed, primary_delay_cause"""
SQL["s1_s5_clean_raw_text"] = f"SELECT {BASE_COLUMNS} FROM flights"
SQL["s6_s10_derived_columns"] = (
    "SELECT flight_date, carrier_code, origin, dest, crs_dep_time, arr_delay, dep_delay,"
    f" {DERIVED_COLUMNS} FROM flights"
)
SQL["s11_s12_parquet_by_month"] = f"SELECT {BASE_COLUMNS}, {DERIVED_COLUMNS} FROM flights"
SQL["s11_s12_reloaded_month"] = (
    SQL["s11_s12_parquet_by_month"] + ' WHERE NOT ("month" = 3 AND cancelled = 1)'
)
SQL["s18_csv_export_reread"] = f"SELECT {BASE_COLUMNS}, {DERIVED_COLUMNS} FROM flights"
SQL["s1_s5_raw_csv_files"] = (
    "SELECT * REPLACE (CASE WHEN \"month\" % 3 = 2 THEN NULL ELSE distance END AS distance,"
    " CASE WHEN day_of_month IN (13, 27) THEN NULL ELSE dep_delay END AS dep_delay)"
    f" FROM (SELECT {BASE_COLUMNS} FROM flights)"
)
SQL["s13_airports_csv_file"] = (
    "SELECT * REPLACE (airport_name || ', \"' || iso_region || '\"' AS airport_name,"
    " CASE WHEN iata_code = 'N01' THEN NULL ELSE longitude END AS longitude)"
    " FROM dim_airports WHERE substr(iata_code, 2)::INTEGER % 4 <> 3"
)
SQL["s13_airports"] = "SELECT * FROM dim_airports"
SQL["s14_carriers"] = """
SELECT carrier_code, carrier_name, COUNT(flight_date) AS total_flights
FROM dim_carriers LEFT JOIN flights USING (carrier_code) GROUP BY ALL"""
SQL["s15_calendar"] = "SELECT * FROM dim_calendar"
LOAD_COLUMNS = [
    "arr_delay", "dep_delay", "arr_delay_minutes", "dep_delay_minutes", "carrier_delay",
    "weather_delay", "cancelled", "origin", "dest",
]
SQL["s17_load_profile"] = (
    "SELECT COUNT(*) AS total_flights, MIN(flight_date) AS first_date, "
    "MAX(flight_date) AS last_date, "
    + rnd("100e0 * AVG(CASE WHEN arr_del15 = 1 THEN 1e0 ELSE 0e0 END)"
          " FILTER (WHERE cancelled = 0)", 1)
    + " AS delay_rate_pct, "
    + ", ".join(f"{pct(f'COUNT(*) - COUNT({c})', digits=1)} AS {c}_null_pct" for c in LOAD_COLUMNS)
    + " FROM flights"
)
SQL["s17_flights_by_month"] = (
    'SELECT "year", "month", COUNT(*) AS flights FROM flights GROUP BY ALL'
)
SQL["s17_top_origins"] = """
SELECT origin, COUNT(*) AS flights FROM flights GROUP BY origin
ORDER BY flights DESC, origin LIMIT 10"""
SQL["s17_top_carriers"] = f"""
SELECT carrier_code, carrier_name, COUNT(*) AS flights, {share(LATE15, 1)} AS delay_pct
FROM flights LEFT JOIN dim_carriers USING (carrier_code)
WHERE cancelled = 0 GROUP BY ALL ORDER BY flights DESC, carrier_code LIMIT 10"""
SQL["s25_capped_sql"] = """
SELECT origin, COUNT(*) AS flights, MAX(arr_delay) AS longest
FROM flights WHERE arr_delay >= 60 GROUP BY origin ORDER BY flights DESC, origin LIMIT 5"""

# Rollups

SQL["v1_daily_airport_summary"] = f"""
SELECT flight_date, origin AS airport, "year", "month", day_of_week,
    COUNT(*) AS total_flights,
    COUNT(*) FILTER (WHERE cancelled = 1) AS cancellations,
    COUNT(*) FILTER (WHERE {LATE15}) AS delayed_flights,
    {share(LATE15)} AS delay_rate,
    {rnd("AVG(arr_delay_minutes)", 1)} AS avg_arr_delay_minutes,
    {rnd("AVG(dep_delay_minutes)", 1)} AS avg_dep_delay_minutes,
    SUM(carrier_delay) AS total_carrier_delay, SUM(weather_delay) AS total_weather_delay,
    SUM(nas_delay) AS total_nas_delay, SUM(late_aircraft_delay) AS total_late_aircraft_delay
FROM flights GROUP BY ALL"""
SQL["v2_monthly_carrier_performance"] = f"""
SELECT "year", "month", carrier_code, carrier_name, COUNT(*) AS total_flights,
    COUNT(*) FILTER (WHERE cancelled = 1) AS cancellations,
    {pct("COUNT(*) FILTER (WHERE cancelled = 1)")} AS cancellation_rate,
    COUNT(*) FILTER (WHERE {LATE15}) AS delayed_flights,
    {rnd("100e0 * (1e0 - AVG(CASE WHEN arr_del15 = 1 THEN 1e0 ELSE 0e0 END))")} AS on_time_pct,
    {rnd("AVG(arr_delay)", 1)} AS avg_arr_delay,
    {rnd(q(0.5, "arr_delay"), 1)} AS median_arr_delay,
    {rnd(q(0.95, "arr_delay"), 1)} AS p95_arr_delay,
    SUM(arr_delay_minutes) AS total_delay_minutes
FROM flights LEFT JOIN dim_carriers USING (carrier_code) GROUP BY ALL"""
SQL["v3_route_reliability"] = f"""
SELECT origin, dest, route, COUNT(*) AS total_flights, {share(LATE15)} AS delay_rate,
    {rnd("100e0 * (1e0 - AVG(CASE WHEN arr_del15 = 1 THEN 1e0 ELSE 0e0 END))")} AS on_time_pct,
    {rnd("AVG(arr_delay_minutes)", 1)} AS avg_delay_minutes,
    {rnd("AVG(distance)", 0)} AS avg_distance,
    COUNT(DISTINCT carrier_code) AS num_carriers
FROM flights WHERE cancelled = 0 GROUP BY ALL HAVING COUNT(*) >= 100"""
SQL["v1_from_states"] = SQL["v1_daily_airport_summary"]
SQL["v2_from_states"] = SQL["v2_monthly_carrier_performance"]
SQL["v3_from_states"] = SQL["v3_route_reliability"]
SQL["s16_view_of_airports"] = SQL["v1_daily_airport_summary"]
SQL["s16_view_of_carriers"] = SQL["v2_monthly_carrier_performance"]
SQL["s16_view_of_routes"] = SQL["v3_route_reliability"]

# Quality

SQL["q1_volume_by_month"] = """
SELECT "year", "month", COUNT(*) AS flight_count, COUNT(DISTINCT origin) AS unique_origins,
    COUNT(DISTINCT dest) AS unique_dests, COUNT(DISTINCT carrier_code) AS unique_carriers,
    MIN(flight_date) AS first_date, MAX(flight_date) AS last_date
FROM flights GROUP BY ALL"""
PROFILED = [
    "arr_delay", "dep_delay", "arr_delay_minutes", "dep_delay_minutes", "carrier_delay",
    "weather_delay", "nas_delay", "cancelled", "cancellation_code", "distance",
]
SQL["q2_null_profile"] = " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, {pct(f'COUNT(*) - COUNT({c})', digits=1)} AS null_pct"
    " FROM flights"
    for c in PROFILED
)
SQL["q3_delay_distribution"] = f"""
SELECT MIN(arr_delay) AS min_delay, {q(0.01, "arr_delay")} AS p01, {q(0.25, "arr_delay")} AS p25,
    {q(0.5, "arr_delay")} AS median, {rnd("AVG(arr_delay)", 1)} AS mean,
    {q(0.75, "arr_delay")} AS p75, {q(0.95, "arr_delay")} AS p95, {q(0.99, "arr_delay")} AS p99,
    MAX(arr_delay) AS max_delay,
    COUNT(*) FILTER (WHERE arr_delay < 0) AS early_arrivals,
    COUNT(*) FILTER (WHERE arr_del15 = 0 AND arr_delay >= 0) AS on_time,
    COUNT(*) FILTER (WHERE {LATE15}) AS delayed
FROM flights"""
SQL["q4_cancellation_codes"] = f"""
SELECT cancellation_code, {reason("NAS (National Aviation System)")} AS reason,
    COUNT(*) AS count, {pct("COUNT(*)", "(SELECT SUM(cancelled) FROM flights)")} AS pct
FROM flights WHERE cancelled = 1 GROUP BY ALL"""
SQL["q5_orphan_airports"] = """
SELECT origin AS orphan_airport, COUNT(*) AS flight_count FROM flights
WHERE origin NOT IN (SELECT iata_code FROM dim_airports)
GROUP BY ALL ORDER BY flight_count DESC, origin LIMIT 20"""
SQL["q6_daily_volume_distribution"] = f"""
SELECT MIN(n) AS min_daily, {q(0.25, "n")} AS p25_daily, {rnd("AVG(n)", 0)} AS avg_daily,
    {q(0.5, "n")} AS median_daily, {q(0.75, "n")} AS p75_daily, MAX(n) AS max_daily,
    COUNT(*) AS total_days
FROM (SELECT COUNT(*) AS n FROM flights GROUP BY flight_date)"""

# Exploratory

SQL["x1_kpi_summary"] = f"""
SELECT COUNT(*) AS total_flights, COUNT(*) - SUM(cancelled)::BIGINT AS completed_flights,
    SUM(cancelled)::BIGINT AS cancelled_flights, {pct("SUM(cancelled)")} AS cancel_rate_pct,
    COUNT(*) FILTER (WHERE {LATE15}) AS delayed_flights,
    {pct("COUNT(*) FILTER (WHERE arr_del15 = 1)", "COUNT(*) - SUM(cancelled)")} AS delay_rate_pct,
    {rnd("AVG(arr_delay) FILTER (WHERE cancelled = 0)", 1)} AS avg_arr_delay_min,
    {rnd("AVG(dep_delay) FILTER (WHERE cancelled = 0)", 1)} AS avg_dep_delay_min,
    {rnd("AVG(arr_delay_minutes) FILTER (WHERE cancelled = 0)", 1)} AS avg_arr_delay_positive_min,
    {rnd("AVG(distance) FILTER (WHERE cancelled = 0)", 0)} AS avg_distance_miles
FROM flights"""
ARR1 = f"{rnd('AVG(arr_delay)', 1)} AS avg_arr_delay"
DEP1 = f"{rnd('AVG(dep_delay)', 1)} AS avg_dep_delay"
MINUTES1 = f"{rnd('AVG(arr_delay_minutes)', 1)} AS avg_delay_min"
SQL["x2_delay_by_hour"] = f"""
SELECT hour_of_day, COUNT(*) AS flights, {share(LATE15)} AS delay_rate_pct, {ARR1}, {DEP1}
FROM flights WHERE cancelled = 0 GROUP BY hour_of_day"""
SQL["x3_delay_by_day_of_week"] = f"""
SELECT day_of_week, {DAY_NAME} AS day_name, COUNT(*) AS flights,
    {share(LATE15)} AS delay_rate_pct, {ARR1}
FROM flights WHERE cancelled = 0 GROUP BY day_of_week"""
SQL["x4_delay_by_month"] = f"""
SELECT "month", {MONTH_ABBR} AS month_name, COUNT(*) AS flights,
    {share(LATE15)} AS delay_rate_pct, {share("cancelled = 1")} AS cancel_rate_pct, {MINUTES1}
FROM flights GROUP BY "month\""""
SQL["x5_busiest_airports"] = f"""
SELECT origin AS airport, airport_name, city, COUNT(*) AS departures,
    {share(LATE15)} AS delay_rate_pct, {MINUTES1}
FROM flights LEFT JOIN dim_airports ON iata_code = origin
GROUP BY ALL ORDER BY departures DESC, airport LIMIT 10"""
SQL["x6_most_delayed_airports"] = f"""
SELECT origin AS airport, airport_name, COUNT(*) AS departures,
    {share(LATE15)} AS delay_rate_pct, {ARR1}, {DEP1}
FROM flights LEFT JOIN dim_airports ON iata_code = origin WHERE cancelled = 0
GROUP BY ALL HAVING COUNT(*) >= 2000 ORDER BY delay_rate_pct DESC, airport LIMIT 10"""
SQL["x7_carrier_on_time"] = f"""
SELECT carrier_code, carrier_name, COUNT(*) AS total_flights,
    {rnd("100e0 * (1e0 - AVG(CASE WHEN arr_del15 = 1 THEN 1e0 ELSE 0e0 END))")} AS on_time_pct,
    {ARR1}, {share("cancelled = 1")} AS cancel_rate_pct,
    {rnd("AVG(arr_delay_minutes)", 1)} AS avg_delay_when_late
FROM flights LEFT JOIN dim_carriers USING (carrier_code)
GROUP BY ALL HAVING COUNT(*) >= 1000"""
SQL["x8_delay_causes"] = (
    "SELECT *, "
    + rnd("100e0 * total_minutes / SUM(total_minutes) OVER ()", 1)
    + " AS pct_of_total FROM ("
    + each_cause(
        "SELECT '{label}' AS cause, SUM({c}) AS total_minutes,"
        " COUNT(*) FILTER (WHERE {c} > 0) AS flight_count FROM flights WHERE arr_del15 = 1",
        " UNION ALL ",
    )
    + ")"
)
SQL["x9_busiest_routes"] = f"""
SELECT route, origin, dest, COUNT(*) AS flights, COUNT(DISTINCT carrier_code) AS num_carriers,
    {share(LATE15)} AS delay_rate_pct, {MINUTES1}, {rnd("AVG(distance)", 0)} AS avg_distance
FROM flights WHERE cancelled = 0 GROUP BY ALL ORDER BY flights DESC, route LIMIT 20"""
SQL["x10_weekend_vs_weekday"] = f"""
SELECT CASE is_weekend WHEN 1 THEN 'Weekend' ELSE 'Weekday' END AS period, COUNT(*) AS flights,
    {share(LATE15)} AS delay_rate_pct, {ARR1}, {DEP1}, {share("cancelled = 1")} AS cancel_rate_pct
FROM flights GROUP BY is_weekend"""
SQL["x11_worst_routes"] = f"""
SELECT route, origin, dest, COUNT(*) AS flights, {share(LATE15)} AS delay_rate_pct, {MINUTES1}
FROM flights WHERE cancelled = 0 GROUP BY ALL HAVING COUNT(*) >= 100
ORDER BY delay_rate_pct DESC, route LIMIT 20"""
SQL["x12_primary_cause_distribution"] = f"""
SELECT primary_delay_cause, COUNT(*) AS flights,
    {pct("COUNT(*)", "(SELECT COUNT(primary_delay_cause) FROM flights)")} AS pct
FROM flights WHERE primary_delay_cause IS NOT NULL GROUP BY ALL"""

# Advanced

SQL["a1_top_carriers"] = f"""
SELECT *, RANK() OVER (ORDER BY on_time_pct DESC)::BIGINT AS rank_on_time,
    DENSE_RANK() OVER (ORDER BY on_time_pct DESC)::BIGINT AS dense_rank_on_time,
    ROW_NUMBER() OVER (ORDER BY on_time_pct DESC, total_flights DESC, carrier_code)::BIGINT
        AS row_num
FROM (
    SELECT carrier_code, carrier_name, COUNT(*) AS total_flights,
        {pct("COUNT(*) FILTER (WHERE arr_del15 = 0)")} AS on_time_pct,
        {rnd("AVG(arr_delay)")} AS avg_arr_delay_min,
        {rnd(q(0.5, "arr_delay"), 1)} AS median_arr_delay,
        {rnd(q(0.95, "arr_delay"), 1)} AS p95_arr_delay
    FROM flights LEFT JOIN dim_carriers USING (carrier_code)
    WHERE cancelled = 0 GROUP BY ALL HAVING COUNT(*) >= 1000
) ORDER BY row_num LIMIT 5"""
SQL["a2_month_over_month"] = f"""
, m AS (
    SELECT "year", "month", COUNT(*) AS flights, {share(LATE15)} AS delay_rate_pct,
        {rnd("AVG(arr_delay)")} AS avg_arr_delay, {share("cancelled = 1")} AS cancel_rate_pct
    FROM flights GROUP BY ALL
), n AS (
    SELECT *, LAG(delay_rate_pct) OVER t AS prev_month_delay_rate,
        LEAD(delay_rate_pct) OVER t AS next_month_delay_rate,
        LAG(avg_arr_delay) OVER t AS prev_avg_arr_delay,
        LAG(cancel_rate_pct) OVER t AS prev_cancel_rate
    FROM m WINDOW t AS (ORDER BY "year", "month")
)
SELECT *, {rnd("delay_rate_pct - prev_month_delay_rate")} AS mom_change_pp,
    {pct("delay_rate_pct - prev_month_delay_rate", "prev_month_delay_rate")} AS mom_change_pct
FROM n"""
SQL["a3_airport_congestion"] = f"""
, port AS (
    SELECT origin AS airport, airport_name, city, COUNT(*) AS departures,
        {share("dep_del15 = 1")} AS dep_delay_rate_pct, {rnd("AVG(dep_delay)")} AS avg_dep_delay,
        {rnd(q(0.9, "dep_delay"), 1)} AS p90_dep_delay,
        {share("cancelled = 1")} AS cancel_rate_pct
    FROM flights LEFT JOIN dim_airports ON iata_code = origin
    GROUP BY ALL HAVING COUNT(*) >= 500
), ranked AS (
    SELECT *, PERCENT_RANK() OVER (ORDER BY dep_delay_rate_pct) AS pr,
        {rnd("0.4e0 * PERCENT_RANK() OVER (ORDER BY dep_delay_rate_pct)"
             " + 0.3e0 * PERCENT_RANK() OVER (ORDER BY avg_dep_delay)"
             " + 0.2e0 * PERCENT_RANK() OVER (ORDER BY p90_dep_delay)"
             " + 0.1e0 * PERCENT_RANK() OVER (ORDER BY cancel_rate_pct)", 4)} AS congestion_score,
        NTILE(5) OVER (ORDER BY dep_delay_rate_pct, airport)::BIGINT AS delay_quintile
    FROM port
)
SELECT * EXCLUDE (pr),
    (['Excellent', 'Good', 'Average', 'Congested', 'Severely Congested'])[delay_quintile]
        AS congestion_tier,
    {rnd("pr", 4)} AS delay_percentile_rank
FROM ranked"""
SQL["a4_delay_cascade"] = f"""
, hit AS (
    SELECT *, arr_delay - dep_delay AS in_air,
        {pct("late_aircraft_delay", "arr_delay_minutes", 1)} AS part
    FROM flights
    WHERE cancelled = 0 AND late_aircraft_delay > 0
        AND dep_delay IS NOT NULL AND arr_delay IS NOT NULL
)
SELECT *, RANK() OVER (ORDER BY avg_in_air_delta DESC)::BIGINT AS cascade_severity_rank
FROM (
    SELECT carrier_code, carrier_name, COUNT(*) AS affected_flights,
        {rnd("AVG(late_aircraft_delay)", 1)} AS avg_late_aircraft_min, {DEP1}, {ARR1},
        {rnd("AVG(in_air)", 1)} AS avg_in_air_delta,
        {mean_of_units("part", 1)} AS avg_late_aircraft_pct,
        COUNT(*) FILTER (WHERE in_air > 0) AS worsened_count,
        COUNT(*) FILTER (WHERE in_air < 0) AS recovered_count,
        {pct("COUNT(*) FILTER (WHERE in_air > 0)", digits=1)} AS pct_worsened,
        CASE WHEN COUNT(*) > 1 THEN {rnd("CORR(late_aircraft_delay, arr_delay)", 4)} END
            AS corr_late_aircraft_arr
    FROM hit LEFT JOIN dim_carriers USING (carrier_code) GROUP BY ALL
)"""
SQL["a5_route_decomposition"] = f"""
, busy AS (
    SELECT route FROM flights WHERE cancelled = 0 GROUP BY route
    ORDER BY COUNT(*) DESC, route LIMIT 50
), sums AS (
    SELECT route, origin, dest, COUNT(*) AS total_flights,
        COUNT(*) FILTER (WHERE {LATE15}) AS delayed_flights, {share(LATE15)} AS delay_rate_pct,
        {rnd("AVG(carrier_delay)")} AS avg_carrier_delay,
        {rnd("AVG(weather_delay)")} AS avg_weather_delay,
        {rnd("AVG(nas_delay)")} AS avg_nas_delay,
        {rnd("AVG(late_aircraft_delay)")} AS avg_late_aircraft_delay,
        SUM(carrier_delay) AS c, SUM(weather_delay) AS w, SUM(nas_delay) AS n,
        SUM(late_aircraft_delay) AS l,
        SUM(carrier_delay + weather_delay + nas_delay + security_delay + late_aircraft_delay) AS t
    FROM flights WHERE cancelled = 0 AND route IN (FROM busy) GROUP BY ALL
)
SELECT * EXCLUDE (c, w, n, l, t),
    {pct("c", "t", 1)} AS pct_carrier, {pct("w", "t", 1)} AS pct_weather,
    {pct("n", "t", 1)} AS pct_nas, {pct("l", "t", 1)} AS pct_late_aircraft,
    CASE GREATEST(c, w, n, l) WHEN c THEN 'Carrier' WHEN w THEN 'Weather' WHEN n THEN 'NAS'
        ELSE 'Late Aircraft' END AS dominant_cause
FROM sums"""
SQL["a6_hub_efficiency"] = f"""
, big AS (
    SELECT COUNT(*) AS n FROM flights GROUP BY origin ORDER BY n DESC LIMIT 10
), hub AS (
    SELECT origin AS airport, airport_name, city, COUNT(*) AS departures,
        {share(LATE15)} AS delay_rate_pct, {rnd("AVG(arr_delay)")} AS avg_arr_delay,
        {rnd("AVG(dep_delay)")} AS avg_dep_delay,
        {rnd(q(0.95, "dep_delay"), 1)} AS p95_dep_delay,
        {share("cancelled = 1")} AS cancel_rate_pct,
        COUNT(DISTINCT dest) AS destinations_served,
        COUNT(DISTINCT carrier_code) AS carriers_operating,
        {rnd("AVG(distance)", 0)} AS avg_route_distance
    FROM flights LEFT JOIN dim_airports ON iata_code = origin
    GROUP BY ALL HAVING COUNT(*) >= (SELECT MIN(n) FROM big)
)
SELECT *, RANK() OVER (ORDER BY delay_rate_pct)::BIGINT AS efficiency_rank,
    DENSE_RANK() OVER (ORDER BY departures DESC)::BIGINT AS volume_rank,
    NTILE(3) OVER (ORDER BY delay_rate_pct, airport)::BIGINT AS efficiency_tier
FROM hub"""
SQL["a7_heatmap_long"] = f"""
SELECT hour_of_day, day_of_week, {DAY_ABBR} AS day_name, COUNT(*) AS flights,
    {share(LATE15)} AS delay_rate_pct, {ARR1}
FROM flights WHERE cancelled = 0 GROUP BY hour_of_day, day_of_week"""
SQL["a7_heatmap_wide"] = (
    "SELECT hour_of_day, "
    + ", ".join(
        rnd(f"100e0 * AVG(CASE WHEN arr_del15 = 1 THEN 1e0 ELSE 0e0 END)"
            f" FILTER (WHERE day_of_week = {i})") + f' AS "{day}"'
        for i, day in enumerate("Mon Tue Wed Thu Fri Sat Sun".split(), 1)
    )
    + " FROM flights WHERE cancelled = 0 GROUP BY hour_of_day"
)
SQL["a8_market_share_vs_delay"] = f"""
, line AS (
    SELECT carrier_code, carrier_name, COUNT(*) AS total_flights,
        {share(LATE15)} AS delay_rate_pct, {rnd("AVG(arr_delay)")} AS avg_arr_delay,
        COUNT(DISTINCT route) AS routes_served, COUNT(DISTINCT origin) AS airports_served
    FROM flights LEFT JOIN dim_carriers USING (carrier_code) WHERE cancelled = 0 GROUP BY ALL
), shared AS (
    SELECT *, {rnd("100e0 * total_flights / SUM(total_flights) OVER ()", 4)} AS market_share_pct
    FROM line
), ranked AS (
    SELECT *, RANK() OVER (ORDER BY market_share_pct DESC)::BIGINT AS market_rank,
        RANK() OVER (ORDER BY delay_rate_pct)::BIGINT AS reliability_rank
    FROM shared
)
SELECT *, market_rank - reliability_rank AS rank_gap,
    CASE WHEN market_rank > reliability_rank + 2 THEN 'Underperformer (big but unreliable)'
         WHEN market_rank < reliability_rank - 2 THEN 'Overperformer (big and reliable)'
         ELSE 'In line with size' END AS performance_vs_size
FROM ranked"""
SQL["a9_cancellations_by_season"] = f"""
, c AS (
    SELECT season, cancellation_code, COUNT(*) AS cancellations
    FROM flights JOIN dim_calendar USING (flight_date) WHERE cancelled = 1 GROUP BY ALL
)
SELECT *, {reason("NAS (National Airspace System)")} AS cancel_reason,
    (SUM(cancellations) OVER s)::BIGINT AS season_total_cancels,
    {rnd("100e0 * cancellations / SUM(cancellations) OVER s", 1)} AS pct_of_season,
    RANK() OVER (PARTITION BY season ORDER BY cancellations DESC)::BIGINT AS cause_rank_in_season
FROM c WINDOW s AS (PARTITION BY season)"""
FRAME = "ORDER BY flight_date ROWS BETWEEN {} AND {}"
LAST7 = FRAME.format("6 PRECEDING", "CURRENT ROW")
SQL["a10_rolling_delay"] = f"""
, d AS (
    SELECT flight_date, COUNT(*) AS flights, {share(LATE15)} AS delay_rate_pct,
        {rnd("AVG(arr_delay)")} AS avg_arr_delay, SUM(arr_delay_minutes) AS total
    FROM flights WHERE cancelled = 0 GROUP BY ALL
)
SELECT flight_date, flights, delay_rate_pct, avg_arr_delay,
    {mean_of_units("delay_rate_pct", 2, LAST7)} AS rolling_7d_delay_rate,
    {mean_of_units("delay_rate_pct", 2, FRAME.format("3 PRECEDING", "3 FOLLOWING"))}
        AS centered_7d_delay_rate,
    {mean_of_units("delay_rate_pct", 2, FRAME.format("13 PRECEDING", "CURRENT ROW"))}
        AS rolling_14d_delay_rate,
    SUM(total) OVER ({LAST7}) AS rolling_7d_total_delay_min,
    MIN(delay_rate_pct) OVER ({LAST7}) AS rolling_7d_min,
    MAX(delay_rate_pct) OVER ({LAST7}) AS rolling_7d_max
FROM d"""
SQL["a11_year_over_year"] = f"""
, m AS (
    SELECT "year", "month", COUNT(*) AS flights, {share(LATE15)} AS delay_rate_pct,
        {rnd("AVG(arr_delay)")} AS a
    FROM flights GROUP BY ALL
), y AS (
    SELECT *, LAG(flights, 12) OVER t AS pf, LAG(delay_rate_pct, 12) OVER t AS pr,
        LAG(a, 12) OVER t AS pa
    FROM m WINDOW t AS (ORDER BY "year", "month")
)
SELECT "year", "month", flights, delay_rate_pct, pf::DOUBLE AS py_flights,
    pr AS py_delay_rate_pct,
    {rnd("delay_rate_pct - COALESCE(pr, 0e0)")} AS yoy_delay_change_pp,
    {pct("flights - COALESCE(pf, 0)", "pf")} AS yoy_flights_change_pct,
    {rnd("a - COALESCE(pa, 0e0)")} AS yoy_avg_delay_change,
    CASE WHEN pr IS NULL THEN 'No prior year' WHEN pr > delay_rate_pct THEN 'Improved'
         WHEN pr < delay_rate_pct THEN 'Degraded' ELSE 'Unchanged' END AS yoy_trend
FROM y"""
SQL["a12_route_severity"] = f"""
, r AS (
    SELECT route, o.city || ' -> ' || d.city AS city_pair, COUNT(*) AS total_flights,
        {share(LATE15)} AS delay_rate_pct, {rnd("AVG(arr_delay_minutes)")} AS avg_delay_when_late,
        {rnd(q(0.95, "arr_delay"), 1)} AS p95_arr_delay,
        {rnd("STDDEV_SAMP(arr_delay)")} AS stddev_arr_delay,
        {pct("SUM(cancelled)")} AS cancel_rate_pct
    FROM flights LEFT JOIN dim_airports o ON o.iata_code = origin
        LEFT JOIN dim_airports d ON d.iata_code = dest
    GROUP BY ALL HAVING COUNT(*) >= 50
), s AS (
    SELECT *, {rnd("0.3e0 * PERCENT_RANK() OVER (ORDER BY delay_rate_pct)"
                   " + 0.25e0 * PERCENT_RANK() OVER (ORDER BY avg_delay_when_late)"
                   " + 0.2e0 * PERCENT_RANK() OVER (ORDER BY p95_arr_delay)"
                   " + 0.15e0 * PERCENT_RANK() OVER (ORDER BY cancel_rate_pct)"
                   " + 0.1e0 * PERCENT_RANK() OVER (ORDER BY stddev_arr_delay)", 4)}
        AS severity_score
    FROM r
)
SELECT *, ROW_NUMBER() OVER (ORDER BY severity_score DESC, route)::BIGINT AS severity_rank
FROM s QUALIFY severity_rank <= 10"""
SQL["a13_connections"] = """
, leg AS (SELECT * FROM flights WHERE cancelled = 0 AND arr_time IS NOT NULL),
trip AS (
    SELECT flight_date, origin AS start_airport, dest AS final_dest, route AS path,
        1::BIGINT AS stops, arr_delay AS total_delay
    FROM leg
    UNION ALL
    SELECT a.flight_date, a.origin, b.dest, a.route || ' -> ' || b.dest, 2,
        a.arr_delay + COALESCE(b.arr_delay, 0)
    FROM leg a JOIN leg b ON b.flight_date = a.flight_date AND b.origin = a.dest
        AND b.dep_time > a.arr_time + 60
)
SELECT *, ROW_NUMBER() OVER (PARTITION BY flight_date, start_airport, final_dest
    ORDER BY total_delay, stops, path)::BIGINT AS route_rank
FROM trip QUALIFY route_rank <= 3"""
# Bucket edges and labels.
EDGES = [
    (-15, "01: >15min Early"),
    (0, "02: On Time / Early"),
    (15, "03: 1-15min Late"),
    (30, "04: 16-30min Late"),
    (60, "05: 31-60min Late"),
    (120, "06: 61-120min Late"),
    (240, "07: 121-240min Late"),
]
SQL["a14_severity_distribution"] = f"""
, b AS (
    SELECT CASE {" ".join(f"WHEN arr_delay <= {e} THEN '{name}'" for e, name in EDGES)}
        ELSE '08: 240+min Late' END AS delay_bucket, COUNT(*) AS flights
    FROM flights WHERE arr_delay IS NOT NULL GROUP BY ALL
)
SELECT *, {rnd("100e0 * flights / SUM(flights) OVER ()")} AS pct_of_total,
    {rnd("100e0 * SUM(flights) OVER (ORDER BY delay_bucket) / SUM(flights) OVER ()")}
        AS cumulative_pct
FROM b"""
SQL["a15_carrier_momentum"] = f"""
, cm AS (
    SELECT carrier_code, "month", {share(LATE15)} AS rate
    FROM flights WHERE cancelled = 0 GROUP BY ALL
), t AS (
    SELECT carrier_code, carrier_name, COUNT("month") AS months_observed,
        {mean_of_units("rate", 2)} AS avg_delay_rate,
        MIN(rate) AS best_month_rate, MAX(rate) AS worst_month_rate,
        arg_min(rate, "month") AS first_month_rate, arg_max(rate, "month") AS last_month_rate,
        CASE WHEN COUNT(*) > 1 THEN {rnd('REGR_SLOPE(rate, "month")', 4)} END AS trend_slope
    FROM cm LEFT JOIN dim_carriers USING (carrier_code) GROUP BY ALL
)
SELECT *, CASE WHEN trend_slope < -0.5 THEN 'Strongly Improving'
    WHEN trend_slope < -0.1 THEN 'Improving' WHEN trend_slope > 0.5 THEN 'Strongly Degrading'
    WHEN trend_slope > 0.1 THEN 'Degrading' ELSE 'Stable' END AS trend_direction,
    RANK() OVER (ORDER BY trend_slope)::BIGINT AS improvement_rank
FROM t"""

# Dashboard results, exports and the rows behind the questions

RATE = f"{DELAY_FLAG_PCT} AS delay_rate"
AVG_DELAY = f"{POSITIVE_AVG} AS avg_delay"
SQL["r1_overview"] = f"""
SELECT COUNT(*) AS total_flights, {ON_TIME_PCT} AS on_time_pct, {DELAY_FLAG_PCT} AS delay_pct,
    {pct("SUM(cancelled)")} AS cancel_pct, {POSITIVE_AVG} AS avg_delay_min
FROM flights"""
SQL["r2_delays_by_hour"] = f"""
SELECT hour_of_day AS hour, {RATE}, {AVG_DELAY}, COUNT(*) AS flight_count
FROM flights WHERE cancelled = 0 GROUP BY hour_of_day"""
CARRIER_BASE = f"""
    SELECT * EXCLUDE (exact), ROW_NUMBER() OVER (ORDER BY exact DESC, carrier_code)::BIGINT AS rank
    FROM (
        SELECT carrier_code, carrier_name, COUNT(*) AS total_flights, {ON_TIME_PCT} AS on_time_pct,
            {DELAY_FLAG_PCT} AS delay_pct, {pct("SUM(cancelled)")} AS cancel_pct, {AVG_DELAY},
            100e0 * COUNT(*) FILTER (WHERE is_delayed = 0 AND cancelled = 0) / COUNT(*) AS exact
        FROM flights JOIN dim_carriers USING (carrier_code) GROUP BY ALL
    )"""
SQL["r3_delays_by_carrier"] = f"SELECT * EXCLUDE (delay_pct, cancel_pct) FROM ({CARRIER_BASE})"
AIRPORT_BASE = f"""
SELECT origin AS airport_code, COALESCE(airport_name, origin) AS airport_name,
    COUNT(*) AS total_flights, {RATE}, {AVG_DELAY}
FROM flights LEFT JOIN dim_airports ON iata_code = origin
WHERE cancelled = 0 GROUP BY origin, dim_airports.airport_name HAVING COUNT(*) >= 1000"""
SQL["r4_delays_by_airport"] = AIRPORT_BASE + " ORDER BY delay_rate DESC, airport_code LIMIT 20"
CAUSE_ROWS = each_cause(
    "SELECT '{label}' AS cause, COALESCE(SUM({c}), 0e0) AS total_minutes"
    " FROM flights WHERE is_delayed = 1",
    " UNION ALL ",
)
SQL["r5_delay_causes"] = f"""
SELECT *, {rnd("100e0 * total_minutes / NULLIF(SUM(total_minutes) OVER (), 0)")} AS percentage
FROM ({CAUSE_ROWS})"""
SQL["r6_monthly_trends"] = f"""
SELECT "year", "month", {RATE}, {AVG_DELAY}, COUNT(*) AS total_flights
FROM flights WHERE cancelled = 0 GROUP BY "year", "month\""""
SQL["r7_day_of_week_patterns"] = f"""
SELECT day_of_week, {DAY_NAME} AS day_name, {RATE}, {AVG_DELAY}, COUNT(*) AS total_flights
FROM flights WHERE cancelled = 0 GROUP BY day_of_week"""
SQL["r8_delay_heatmap"] = f"""
SELECT hour_of_day AS hour, day_of_week, {RATE}, COUNT(*) AS flight_count
FROM flights WHERE cancelled = 0 GROUP BY hour_of_day, day_of_week"""
ROUTE_BASE = f"""
SELECT route, origin, dest, COUNT(*) AS total_flights, {RATE}, {AVG_DELAY}
FROM flights WHERE cancelled = 0 GROUP BY ALL HAVING COUNT(*) >= 100 """
SQL["r9_worst_routes"] = ROUTE_BASE + "ORDER BY delay_rate DESC, route LIMIT 20"
SQL["r9_best_routes"] = ROUTE_BASE + "ORDER BY delay_rate, route LIMIT 20"
SQL["r10_cancellations"] = f"""
SELECT cancellation_code, {reason("NAS")} AS reason, COUNT(*) AS count,
    {pct("COUNT(*)", "(SELECT SUM(cancelled) FROM flights)")} AS percentage
FROM flights WHERE cancelled = 1 GROUP BY ALL"""
SQL["r11_carrier_ranking"] = f"SELECT * FROM ({CARRIER_BASE})"

SQL["d1_overview"] = SQL["r1_overview"]
SQL["d2_carriers"] = f"SELECT * EXCLUDE (rank) FROM ({CARRIER_BASE})"
SQL["d3_airports"] = AIRPORT_BASE
SQL["d4_hourly"] = SQL["r2_delays_by_hour"]
SQL["d5_causes"] = CAUSE_ROWS
SQL["d6_trends"] = SQL["r6_monthly_trends"]
SQL["d7_cancellations"] = f"""
SELECT cancellation_code, {reason("NAS")} AS reason, COUNT(*) AS count
FROM flights WHERE cancelled = 1 GROUP BY ALL"""
SQL["s21_dataset_csv_reread"] = SQL["d2_carriers"]
SQL["s22_dataset_json_reread"] = SQL["r6_monthly_trends"]
SQL["s24_report_table_reread"] = ""

SQL["n1_best_airline"] = f"SELECT * EXCLUDE (delay_pct, cancel_pct, rank) FROM ({CARRIER_BASE})"
SQL["n2_worst_airline"] = f"""
SELECT carrier_code, carrier_name, total_flights, delay_pct AS delay_rate, avg_delay
FROM ({CARRIER_BASE})"""
SQL["n3_airline_ranking"] = f"""
SELECT carrier_code, carrier_name, total_flights, on_time_pct, delay_pct AS delay_rate, avg_delay
FROM ({CARRIER_BASE})"""
SQL["n4_peak_delay_hours"] = SQL["r2_delays_by_hour"]
SQL["n5_delay_causes"] = SQL["r5_delay_causes"]
SQL["n6_weather_delays"] = f"""
SELECT season, {rnd("AVG(weather_delay)")} AS avg_weather_delay,
    COUNT(*) FILTER (WHERE weather_delay > 0) AS weather_delayed_flights,
    COUNT(*) AS total_flights
FROM flights JOIN dim_calendar USING (flight_date) WHERE cancelled = 0 GROUP BY season"""
SQL["n7_airport_comparison"] = SQL["r4_delays_by_airport"]
SQL["n8_busiest_airport"] = """
SELECT origin AS airport_code, COALESCE(airport_name, origin) AS airport_name,
    COUNT(*) AS total_flights
FROM flights LEFT JOIN dim_airports ON iata_code = origin
GROUP BY origin, dim_airports.airport_name ORDER BY total_flights DESC, airport_code LIMIT 20"""
SQL["n9_cancellation_info"] = SQL["d7_cancellations"]
SQL["n10_monthly_trends"] = SQL["r6_monthly_trends"]
SQL["n11_seasonal"] = f"""
SELECT season, {RATE}, {AVG_DELAY}, COUNT(*) AS total_flights
FROM flights JOIN dim_calendar USING (flight_date) WHERE cancelled = 0 GROUP BY season"""
SQL["n12_route_analysis"] = ROUTE_BASE + "ORDER BY delay_rate DESC, route LIMIT 20"
SQL["n13_general_stats"] = SQL["r1_overview"]

# Questions

# Sample questions with their intents, intent patterns in matching order,
# and the opening sentence and chart of each answer.
QUESTIONS = [
    ("Which airline has the best on-time performance?", "best_airline"),
    ("What are the main causes of flight delays?", "delay_causes"),
    ("Which hours have the worst delays?", "peak_delay_hours"),
    ("Show me monthly delay trends", "monthly_trends"),
    ("Which airports have the highest delay rate?", "airport_comparison"),
    ("What is the cancellation breakdown?", "cancellation_info"),
    ("How does weather affect delays?", "weather_delays"),
    ("What are the busiest airports?", "busiest_airport"),
    ("Show me the worst routes for delays", "route_analysis"),
    ("Give me an overview of all flights", "general_stats"),
]
QUESTION_LIST = "[" + ", ".join(f"'{text}'" for text, _ in QUESTIONS) + "]"
INTENT_LIST = "[" + ", ".join(f"'{intent}'" for _, intent in QUESTIONS) + "]"
ASKED = (
    f"SELECT event_id AS question_id, ({QUESTION_LIST})[event_id % 10 + 1] AS question,"
    f" ({INTENT_LIST})[event_id % 10 + 1] AS intent FROM events"
)
INTENT_REGEX = {
    intent: "|".join(patterns)
    for intent, patterns in INTENT_PATTERNS.items()
    if intent != FALLBACK_INTENT
}
INTENT_CASE = (
    "CASE "
    + " ".join(
        f"WHEN regexp_matches(lower(text), '{regex}') THEN '{intent}'"
        for intent, regex in INTENT_REGEX.items()
    )
    + " ELSE 'general_stats' END"
)
SQL["n0_classify_questions"] = ASKED
PHRASES = [
    "best airline for", "worst carrier of", "rank every airline by", "busiest hour of", "cause of",
    "weather and", "airport delay near", "largest airport for", "cancelled", "monthly trend of",
    "season of", "city pair for", "how many",
]
SQL["n0_classify_composed"] = (
    f"SELECT p_partkey, {INTENT_CASE} AS intent FROM (SELECT p_partkey, concat_ws(' ', p_name,"
    f" ({PHRASES})[p_partkey % 13 + 1], p_type, lower(p_brand)) AS text FROM part)"
)
SQL["n0_classify_documents"] = f"SELECT doc_id, {INTENT_CASE} AS intent FROM documents"
SQL["n0_classify_conversations"] = f"SELECT conv_id, turn, {INTENT_CASE} AS intent FROM conversations"
SQL["n16_sample_questions"] = f"""
SELECT question, COUNT(*) AS asked FROM ({ASKED}) GROUP BY question"""
INSIGHTS = f"""
, line AS ({CARRIER_BASE}),
hourly AS ({SQL["r2_delays_by_hour"]}),
cause AS ({SQL["r5_delay_causes"]}),
kpi AS ({SQL["r1_overview"]}),
best AS (SELECT carrier_name || ' leads with ' || on_time_pct || '% on-time performance across '
        || format('{{:,}}', total_flights) || ' flights.' AS s
    FROM line ORDER BY on_time_pct DESC, carrier_code LIMIT 1),
insight AS (
    SELECT 'best_airline' AS intent, s AS insight FROM best
    UNION ALL SELECT 'airline_ranking', s FROM best
    UNION ALL (SELECT 'worst_airline', carrier_name || ' has the highest delay rate at '
        || delay_pct || '%.' FROM line ORDER BY delay_pct DESC, carrier_code LIMIT 1)
    UNION ALL (SELECT 'peak_delay_hours', 'Hour ' || hour || ':00 has the highest delay rate at '
        || delay_rate || '%.' FROM hourly ORDER BY delay_rate DESC, hour LIMIT 1)
    UNION ALL (SELECT 'delay_causes', '''' || cause || ''' is the leading delay cause, '
        || 'accounting for ' || percentage || '% of total delay minutes.'
        FROM cause ORDER BY total_minutes DESC, cause LIMIT 1)
    UNION ALL SELECT 'general_stats', 'The dataset contains '
        || format('{{:,}}', total_flights) || ' flights. On-time: ' || on_time_pct
        || '%, Delayed: ' || delay_pct || '%, Cancelled: ' || cancel_pct || '%.' FROM kpi
    UNION ALL SELECT unnest(['weather_delays', 'busiest_airport', 'cancellation_info',
        'monthly_trends', 'seasonal']), ''
    UNION ALL SELECT 'airport_comparison', CASE WHEN EXISTS ({AIRPORT_BASE})
        THEN '' ELSE 'No data found for your query.' END
    UNION ALL SELECT 'route_analysis', CASE WHEN EXISTS (
            SELECT 1 FROM flights WHERE cancelled = 0 GROUP BY route HAVING COUNT(*) >= 100)
        THEN '' ELSE 'No data found for your query.' END
)
"""
# The rows behind each answer: order, text columns and number columns (``#``), as they come.
ANSWER_ROWS = {
    "n1_best_airline": ("on_time_pct DESC, carrier_code",
                        "carrier_code carrier_name #total_flights #on_time_pct #avg_delay"),
    "n2_worst_airline": ("delay_rate DESC, carrier_code",
                         "carrier_code carrier_name #total_flights #delay_rate #avg_delay"),
    "n3_airline_ranking": ("on_time_pct DESC, carrier_code", "carrier_code carrier_name"
                           " #total_flights #on_time_pct #delay_rate #avg_delay"),
    "n4_peak_delay_hours": ("hour", "#hour #delay_rate #avg_delay #flight_count"),
    "n5_delay_causes": ("total_minutes DESC, cause", "cause #total_minutes #percentage"),
    "n6_weather_delays": ("avg_weather_delay DESC, season",
                          "season #avg_weather_delay #weather_delayed_flights #total_flights"),
    "n7_airport_comparison": ("delay_rate DESC, airport_code",
                              "airport_code airport_name #total_flights #delay_rate #avg_delay"),
    "n8_busiest_airport": ("total_flights DESC, airport_code",
                           "airport_code airport_name #total_flights"),
    "n9_cancellation_info": ("count DESC, cancellation_code", "cancellation_code reason #count"),
    "n10_monthly_trends": ('"year", "month"', "#year #month #delay_rate #avg_delay #total_flights"),
    "n11_seasonal": ("delay_rate DESC, season", "season #delay_rate #avg_delay #total_flights"),
    "n12_route_analysis": ("delay_rate DESC, route",
                           "route origin dest #total_flights #delay_rate #avg_delay"),
    "n13_general_stats": ("1", "#total_flights #on_time_pct #delay_pct #cancel_pct #avg_delay_min"),
}


def _answer_part(name: str) -> str:
    order, columns = ANSWER_ROWS[name]
    fields = ", ".join(
        f'"{c[1:]}" := "{c[1:]}"::DECIMAL(20, 2)::VARCHAR' if c[0] == "#" else f'"{c}" := "{c}"'
        for c in columns.split()
    )
    intent = name.split("_", 1)[1]
    return (
        f"SELECT '{intent}' AS intent, ROW_NUMBER() OVER (ORDER BY {order}) AS position,"
        f" to_json(struct_pack({fields}))::VARCHAR AS row FROM {name}"
    )


SQL["n15_answer_rows"] = (
    ", " + ", ".join(f"{name} AS ({SQL[name].lstrip().removeprefix(',')})" for name in ANSWER_ROWS
                     if not SQL[name].lstrip().startswith(","))
    + " " + " UNION ALL ".join(map(_answer_part, ANSWER_ROWS))
)
SQL["n14_insights"] = INSIGHTS + "SELECT * FROM insight"
OPENINGS = {
    "best_airline": (
        "Here are the airlines ranked from best to worst on-time performance:", "bar"),
    "delay_causes": ("Here is the breakdown of delay causes by total minutes:", "pie"),
    "peak_delay_hours": (
        "Here is the delay pattern across different hours of the day:", "line"),
    "monthly_trends": ("Here are the monthly delay trends:", "line"),
    "airport_comparison": ("Here are the airports compared by delay rate:", "bar"),
    "cancellation_info": ("Here is the cancellation breakdown by reason:", "pie"),
    "weather_delays": ("Here is the weather delay analysis by season:", "bar"),
    "busiest_airport": ("Here are the busiest airports by flight volume:", "bar"),
    "route_analysis": ("Here are the routes with the highest delay rates:", "bar"),
    "general_stats": ("Here is a general overview of the flight dataset:", "kpi"),
}
OPENING_ROWS = ", ".join(f"('{k}', '{text}', '{c}')" for k, (text, c) in OPENINGS.items())
SQL["n15_answer_questions"] = (
    INSIGHTS
    + f""", opening AS (FROM (VALUES {OPENING_ROWS}) AS v(intent, opening, chart_type))
SELECT asked.*, opening || CASE insight WHEN '' THEN '' ELSE chr(10) || chr(10) || insight END
        AS answer, chart_type
FROM ({ASKED}) AS asked JOIN opening USING (intent) JOIN insight USING (intent)"""
)

# Chart data

PROFILE = f"AVG(arr_delay_minutes) AS avg_delay, {FLAG_RATIO} AS delay_rate"
AVG_DEP = "AVG(dep_delay_minutes) AS avg_dep_delay"
SQL["p1_delay_histogram"] = """
SELECT (arr_delay_minutes::BIGINT // 5 * 5)::DOUBLE AS bin, COUNT(*) AS cnt
FROM flights WHERE arr_delay_minutes <= 180 GROUP BY ALL"""
SQL["p2_delay_stats"] = f"""
SELECT AVG(arr_delay_minutes) AS mean_delay, {q(0.5, "arr_delay_minutes")} AS median_delay,
    {q(0.95, "arr_delay_minutes")} AS p95_delay, MAX(arr_delay_minutes) AS max_delay,
    COUNT(arr_delay_minutes) AS n
FROM flights"""
BOX = f"""{q(0.25, "arr_delay_minutes")} AS q1, {q(0.5, "arr_delay_minutes")} AS median,
    {q(0.75, "arr_delay_minutes")} AS q3, MIN(arr_delay_minutes) AS minv,
    MAX(arr_delay_minutes) AS maxv"""
SQL["p3_delay_box"] = f"""
SELECT *, GREATEST(minv, q1 - 1.5e0 * (q3 - q1)) AS whisker_lo,
    LEAST(maxv, q3 + 1.5e0 * (q3 - q1)) AS whisker_hi
FROM (SELECT {BOX} FROM flights WHERE arr_delay_minutes <= 180)"""
CORRELATED = ["arr_delay_minutes", "dep_delay_minutes", "distance", *CAUSES.values()]
SQL["p4_correlation_matrix"] = " UNION ALL ".join(
    f"SELECT '{a}' AS col_a, '{b}' AS col_b, {rnd(f'CORR({a}, {b})', 4)} AS r FROM flights"
    for i, a in enumerate(CORRELATED)
    for b in CORRELATED[i + 1 :]
)
NULLABLE = [
    "dep_time", "dep_delay", "dep_delay_minutes", "arr_time", "arr_delay", "arr_delay_minutes",
    "cancellation_code", *CAUSES.values(), "arr_del15", "dep_del15", "primary_delay_cause",
]
SQL["p5_missing_values"] = " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", (COUNT(*) - COUNT({c}))::DOUBLE / COUNT(*) * 100e0"
    " AS missing_pct FROM flights HAVING COUNT(*) > COUNT(" + c + ")"
    for c in NULLABLE
)
SQL["p6_daily_volume"] = """
SELECT flight_date, n AS flights, CASE WHEN COUNT(*) OVER w = 7 THEN AVG(n) OVER w END AS ma7
FROM (SELECT flight_date, COUNT(*) AS n FROM flights GROUP BY ALL)
WINDOW w AS (ORDER BY flight_date ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING)"""
SQL["p6_peak_day"] = """
SELECT arg_min(flight_date, (-n, flight_date)) AS peak_date, MAX(n) AS peak_flights,
    AVG(n) AS avg_daily_flights
FROM (SELECT flight_date, COUNT(*) AS n FROM flights GROUP BY ALL)"""
SQL["p7_carrier_delay_rates"] = f"""
, r AS (
    SELECT carrier_code, COUNT(*) AS total, SUM(is_delayed)::BIGINT AS delayed,
        {FLAG_RATIO} AS delay_rate
    FROM flights GROUP BY ALL
)
SELECT *, (delay_rate > (SELECT MEDIAN(delay_rate) FROM r))::INTEGER AS above_median,
    (SELECT {rnd("AVG(delay_rate)", 6)} FROM r) AS mean_rate
FROM r"""
SQL["p8_dep_arr_sample"] = """
SELECT dep_delay_minutes, arr_delay_minutes FROM flights
WHERE dep_delay_minutes IS NOT NULL AND arr_delay_minutes IS NOT NULL
ORDER BY md5(concat_ws('|', flight_date::VARCHAR, carrier_code, origin, dest,
    coalesce(crs_dep_time::VARCHAR, '~'), coalesce(dep_delay::VARCHAR, '~'),
    coalesce(arr_delay::VARCHAR, '~'), coalesce(distance::VARCHAR, '~')))
LIMIT 5000"""
SQL["p8_axis_limit"] = f"""
SELECT greatest({q(0.99, "dep_delay_minutes")}, {q(0.99, "arr_delay_minutes")}) AS axis_limit
FROM flights WHERE dep_delay_minutes IS NOT NULL AND arr_delay_minutes IS NOT NULL"""
SQL["p9_dep_arr_correlation"] = f"""
SELECT {rnd("CORR(dep_delay_minutes, arr_delay_minutes)", 4)} AS r FROM flights"""
SQL["p10_dataset_overview"] = """
SELECT COUNT(*) AS "rows", MIN(flight_date) AS date_min, MAX(flight_date) AS date_max,
    COUNT(DISTINCT carrier_code) AS carriers, COUNT(DISTINCT origin) AS origins,
    COUNT(DISTINCT dest) AS dests, SUM(cancelled)::BIGINT AS cancelled,
    AVG(cancelled::DOUBLE) * 100e0 AS cancel_pct, SUM(is_delayed)::BIGINT AS delayed,
    AVG(is_delayed::DOUBLE) * 100e0 AS delay_pct
FROM flights"""
SQL["p11_hourly_profile"] = f"""
SELECT hour_of_day, {PROFILE}, COUNT(*) AS flights FROM flights GROUP BY hour_of_day"""
SQL["p11_peak_hour"] = f"""
SELECT hour_of_day, avg_delay FROM (
    SELECT hour_of_day, {PROFILE} FROM flights GROUP BY hour_of_day
) ORDER BY avg_delay DESC, hour_of_day LIMIT 1"""
SQL["p12_cause_shares"] = (
    "SELECT *, minutes / SUM(minutes) OVER () * 100e0 AS share FROM ("
    + each_cause(
        "SELECT '{label}' AS cause, COALESCE(SUM({c}), 0e0) AS minutes FROM flights",
        " UNION ALL ",
    )
    + ")"
)
SQL["p13_carrier_cause_means"] = (
    f"SELECT carrier_code, {each_cause('AVG({c}) AS {c}')} FROM flights GROUP BY carrier_code"
)
SHORT_DELAYS = "is_delayed = 1 AND arr_delay_minutes <= 180"
SQL["p14_carrier_delay_boxes"] = f"""
SELECT *, GREATEST(minv, q1 - 1.5e0 * (q3 - q1)) AS whislo,
    LEAST(maxv, q3 + 1.5e0 * (q3 - q1)) AS whishi
FROM (SELECT carrier_code, {BOX}, COUNT(*) AS n FROM flights
      WHERE {SHORT_DELAYS} GROUP BY carrier_code)"""
SQL["p15_delayed_median"] = f"""
SELECT {q(0.5, "arr_delay_minutes")} AS med FROM flights WHERE {SHORT_DELAYS}"""
# Severity labels.
SEVERITY = ["On-time / Early", "Minor (1-15)", "Moderate (16-60)", "Severe (61-120)",
            "Extreme (>120)"]
SQL["p16_severity_breakdown"] = f"""
, s AS (
    SELECT unnest([{", ".join(f"'{name}'" for name in SEVERITY)}]) AS severity,
        unnest([-1, 0, 15, 60, 120]) AS low, unnest([0, 15, 60, 120, 1000000]) AS high
), c AS (
    SELECT severity, NULLIF(COUNT(arr_delay_minutes), 0) AS cnt
    FROM s LEFT JOIN flights ON arr_delay_minutes > low AND arr_delay_minutes <= high
    GROUP BY severity
)
SELECT *, cnt / SUM(cnt) OVER ()::DOUBLE * 100e0 AS pct FROM c"""
SQL["p16_severe_total"] = """
SELECT COUNT(*) FILTER (WHERE arr_delay_minutes > 60) AS severe_count,
    COUNT(*) FILTER (WHERE arr_delay_minutes > 60)::DOUBLE / COUNT(arr_delay_minutes) * 100e0
        AS severe_pct
FROM flights"""
SQL["p17_monthly_profile"] = f"""
SELECT "month", {PROFILE}, COUNT(*) AS flights FROM flights GROUP BY "month\""""
SQL["p18_weekend_profile"] = f"""
SELECT is_weekend, {PROFILE}, COUNT(*) AS flights, {AVG_DEP} FROM flights GROUP BY is_weekend"""
SQL["p19_day_of_week_profile"] = f"""
SELECT day_of_week, {DAY_ABBR} AS day_name, {PROFILE} FROM flights GROUP BY day_of_week"""
SQL["p20_busiest_airports"] = """
, ends AS (
    SELECT origin AS airport, 1 AS out, 0 AS back FROM flights
    UNION ALL SELECT dest, 0, 1 FROM flights
)
SELECT airport, SUM(out)::BIGINT AS departures, SUM(back)::BIGINT AS arrivals,
    COUNT(*) AS total
FROM ends GROUP BY airport ORDER BY total DESC, airport LIMIT 20"""
SQL["p21_most_delayed_airports"] = f"""
SELECT origin, COUNT(*) AS flights, {FLAG_RATIO} AS delay_rate,
    AVG(arr_delay_minutes) AS avg_delay
FROM flights GROUP BY origin HAVING COUNT(*) >= 2000
ORDER BY delay_rate DESC, origin LIMIT 20"""
SQL["p22_airport_quadrants"] = f"""
, p AS (
    SELECT origin, COUNT(*) AS flights, {PROFILE} FROM flights GROUP BY origin
    HAVING COUNT(*) >= 2000
)
SELECT *, CASE WHEN flights > (SELECT MEDIAN(flights) FROM p) THEN 'high' ELSE 'low' END
    || ' volume / '
    || CASE WHEN delay_rate > (SELECT MEDIAN(delay_rate) FROM p) THEN 'high' ELSE 'low' END
    || ' delay' AS quadrant
FROM p"""
HUBS = [f"N{i:02d}" for i in range(15)]
SQL["p23_hub_comparison"] = f"""
SELECT origin, COUNT(*) AS flights, {PROFILE}, {AVG_DEP}, AVG(cancelled::DOUBLE) AS cancel_rate
FROM flights WHERE origin IN ({", ".join(f"'{h}'" for h in HUBS)}) GROUP BY origin"""
SQL["p24_geographic_delay"] = f"""
SELECT origin, longitude, latitude, COUNT(*) AS flights, {PROFILE}
FROM flights JOIN dim_airports ON iata_code = origin
WHERE longitude > -130 AND longitude < -65 AND latitude > 24 AND latitude < 50
GROUP BY origin, longitude, latitude HAVING COUNT(*) >= 500"""
SQL["p25_monthly_trend"] = f"""
SELECT "month", {PROFILE}, COUNT(*) AS flights, {AVG_DEP} FROM flights GROUP BY "month\""""
SQL["p26_day_of_week_pattern"] = f"""
SELECT day_of_week, {DAY_ABBR} AS day_name, {PROFILE}, COUNT(*) AS flights
FROM flights GROUP BY day_of_week"""
SQL["p27_day_hour_matrix"] = (
    "SELECT day_of_week, "
    + ", ".join(
        f"AVG(arr_delay_minutes) FILTER (WHERE hour_of_day = {h}) AS h{h}" for h in range(24)
    )
    + " FROM flights GROUP BY day_of_week"
)
SQL["p28_weekly_trend"] = f"""
, w AS (
    SELECT (flight_date - (day_of_week - 1)::INTEGER)::DATE AS week_start,
        weekofyear(flight_date)::INTEGER AS week_num, {PROFILE}, COUNT(*) AS flights
    FROM flights GROUP BY ALL
)
SELECT *, CASE WHEN ROW_NUMBER() OVER (PARTITION BY week_num ORDER BY week_start) = 1 THEN
    CASE week_num WHEN 1 THEN 'New Year' WHEN 7 THEN 'Valentine''s' WHEN 9 THEN 'Presidents'' Day'
        WHEN 13 THEN 'Spring Break' WHEN 18 THEN 'Memorial Day' END END AS label
FROM w"""
WINDOWS_1998 = [
    ("New Year", "1998-01-01", "1998-01-03"),
    ("MLK Weekend", "1998-01-16", "1998-01-19"),
    ("Presidents' Day", "1998-02-13", "1998-02-16"),
    ("Spring Break", "1998-03-13", "1998-03-22"),
    ("Memorial Day", "1998-05-22", "1998-05-25"),
]
WINDOW_ROWS = ", ".join(
    "('{}', DATE '{}', DATE '{}')".format(name.replace("'", "''"), start, end)
    for name, start, end in WINDOWS_1998
)
SQL["p29_holiday_periods"] = f"""
, span AS (FROM (VALUES {WINDOW_ROWS}) AS v(period, first_day, last_day)),
every AS (SELECT {FLAG_RATIO} AS baseline_rate FROM flights)
SELECT period, COUNT(*) AS flights, {FLAG_RATIO} AS delay_rate,
    AVG(arr_delay_minutes) AS avg_delay, MIN(baseline_rate) AS baseline_rate,
    ({FLAG_RATIO} > MIN(baseline_rate))::INTEGER AS above_baseline
FROM span JOIN flights ON flight_date BETWEEN first_day AND last_day, every
GROUP BY period"""

# Report tables

RATIO_PCT = "AVG({0}::DOUBLE) * 100e0"
DELAYED = f"SUM(is_delayed)::BIGINT AS delayed, {rnd(RATIO_PCT.format('is_delayed'))} AS delay_rate_pct"
ARR2 = f"{rnd('AVG(arr_delay_minutes)')} AS avg_arr_delay_min"
DEP2 = f"{rnd('AVG(dep_delay_minutes)')} AS avg_dep_delay_min"
CANCELLED = (
    f"SUM(cancelled)::BIGINT AS cancelled, {rnd(RATIO_PCT.format('cancelled'))} AS cancel_rate_pct"
)
SUMMARY = {
    "total_flights": "COUNT(*)",
    "delayed_flights": "SUM(is_delayed)",
    "delay_rate_pct": rnd(RATIO_PCT.format("is_delayed")),
    "cancelled_flights": "SUM(cancelled)",
    "cancel_rate_pct": rnd(RATIO_PCT.format("cancelled")),
    "avg_arrival_delay_min": rnd("AVG(arr_delay_minutes)"),
    "avg_departure_delay_min": rnd("AVG(dep_delay_minutes)"),
    "median_arrival_delay_min": rnd(q(0.5, "arr_delay_minutes")),
    "p95_arrival_delay_min": rnd(q(0.95, "arr_delay_minutes")),
    "carriers": "COUNT(DISTINCT carrier_code)",
    "origin_airports": "COUNT(DISTINCT origin)",
    "date_start": "MIN(flight_date)",
    "date_end": "MAX(flight_date)",
}
SQL["e1_summary"] = " UNION ALL ".join(
    f"SELECT '{name}' AS \"Metric\", ({expr})::VARCHAR AS \"Value\" FROM flights"
    for name, expr in SUMMARY.items()
)
SQL["e2_hourly"] = f"""
SELECT hour_of_day AS hour, COUNT(*) AS flights, {DELAYED}, {ARR2}, {DEP2}
FROM flights GROUP BY hour_of_day"""
SQL["e3_carrier_performance"] = f"""
SELECT carrier_code, carrier_name, COUNT(*) AS flights, {DELAYED}, {ARR2}, {DEP2}, {CANCELLED},
    {rnd("AVG(carrier_delay)")} AS avg_carrier_delay,
    {rnd("AVG(weather_delay)")} AS avg_weather_delay, {rnd("AVG(nas_delay)")} AS avg_nas_delay,
    {rnd("AVG(late_aircraft_delay)")} AS avg_late_aircraft_delay
FROM flights LEFT JOIN dim_carriers USING (carrier_code) GROUP BY ALL"""
SQL["e4_airport_performance"] = f"""
SELECT origin AS airport, airport_name, city, iso_region AS state, COUNT(*) AS departures,
    {DELAYED}, {ARR2}, {CANCELLED}
FROM flights LEFT JOIN dim_airports ON iata_code = origin
GROUP BY ALL HAVING COUNT(*) >= 100"""
SQL["e5_monthly"] = f"""
SELECT "month", COUNT(*) AS flights, {DELAYED}, {ARR2}, {DEP2}, {CANCELLED}
FROM flights GROUP BY "month\""""
SQL["e6_delay_causes"] = (
    "SELECT carrier_code, COUNT(*) AS delayed_flights, "
    + each_cause("(ROUND(SUM({c})) + 0e0) AS total_{c}_min")
    + ", "
    + each_cause("(ROUND(AVG({c}), 2) + 0e0) AS avg_{c}")
    + " FROM flights WHERE is_delayed = 1 GROUP BY carrier_code"
)
SQL["s24_report_table_reread"] = SQL["e3_carrier_performance"]
SQL["s24_summary_reread"] = SQL["e1_summary"]
SQL["s24_hourly_reread"] = SQL["e2_hourly"]
SQL["s24_airports_reread"] = SQL["e4_airport_performance"]
SQL["s24_monthly_reread"] = SQL["e5_monthly"]
SQL["s24_causes_reread"] = SQL["e6_delay_causes"]

# BI measures and chart reshapes

ON_TIME_RATIO = (
    "COALESCE(COUNT(*) FILTER (WHERE arr_del15 = 0 AND cancelled = 0)::DOUBLE"
    " / NULLIF(COUNT(*) FILTER (WHERE cancelled = 0), 0), 0e0)"
)
SQL["b1_b4_measures_by_carrier"] = f"""
SELECT carrier_code, {ON_TIME_RATIO} AS on_time, 1e0 - {ON_TIME_RATIO} AS delay,
    AVG(arr_delay_minutes) FILTER (WHERE cancelled = 0) AS avg_delay_min,
    SUM(cancelled)::DOUBLE / COUNT(*) AS cancel
FROM flights GROUP BY carrier_code"""
SQL["b1_b4_measures_overall"] = SQL["b1_b4_measures_by_carrier"].replace(
    "SELECT carrier_code,", "SELECT"
).replace(" GROUP BY carrier_code", "")
SQL["b5_yoy_delay_change"] = """
, m AS (
    SELECT "year", "month", AVG(arr_delay_minutes) FILTER (WHERE cancelled = 0) AS a
    FROM flights GROUP BY ALL
)
SELECT m."year", m."month", m.a AS avg_delay_min, p.a AS prior_year,
    COALESCE((m.a - p.a) / NULLIF(p.a, 0), 0e0) AS yoy_delay_change
FROM m LEFT JOIN m p ON p."month" = m."month" AND p."year" = m."year" - 1"""
SQL["f1_carriers_by_delay"] = f"""
SELECT * FROM ({CARRIER_BASE}) ORDER BY avg_delay, carrier_code LIMIT 15"""
SQL["f2_normalised_heatmap"] = f"""
, cell AS ({SQL["r8_delay_heatmap"]}),
edge AS (SELECT MIN(delay_rate) AS lo, MAX(delay_rate) AS hi FROM cell)
SELECT cell.*, CASE WHEN hi = lo THEN 0e0 ELSE (delay_rate - lo) / (hi - lo) END AS intensity
FROM cell, edge"""
SQL["f3_month_labels"] = f"""
SELECT *, {MONTH_ABBR} || ' ' || "year" AS label FROM ({SQL["r6_monthly_trends"]})"""

# Model features

TOP50 = (
    "SELECT {c}, {c} AS keep FROM known GROUP BY {c} ORDER BY COUNT(*) DESC, {c} LIMIT 50"
)
SQL["m2_m5_features"] = f"""
, known AS (SELECT * FROM flights WHERE arr_delay_minutes IS NOT NULL),
o AS ({TOP50.format(c="origin")}), d AS ({TOP50.format(c="dest")}),
coded AS (
    SELECT *, COALESCE(o.keep, 'OTHER') AS og, COALESCE(d.keep, 'OTHER') AS dg
    FROM known LEFT JOIN o USING (origin) LEFT JOIN d USING (dest)
)
SELECT (DENSE_RANK() OVER (ORDER BY carrier_code) - 1)::DOUBLE AS carrier_enc,
    (DENSE_RANK() OVER (ORDER BY og) - 1)::DOUBLE AS origin_enc,
    (DENSE_RANK() OVER (ORDER BY dg) - 1)::DOUBLE AS dest_enc,
    distance, hour_of_day, {rnd("sin(2 * pi() * hour_of_day / 24)", 6)} AS hour_sin,
    {rnd("cos(2 * pi() * hour_of_day / 24)", 6)} AS hour_cos,
    day_of_week, {rnd("sin(2 * pi() * day_of_week / 7)", 6)} AS dow_sin,
    {rnd("cos(2 * pi() * day_of_week / 7)", 6)} AS dow_cos,
    "month", {rnd('sin(2 * pi() * "month" / 12)', 6)} AS month_sin,
    {rnd('cos(2 * pi() * "month" / 12)', 6)} AS month_cos,
    day_of_month, "quarter", is_weekend, is_delayed::DOUBLE AS label
FROM coded"""

# The split: of each label the fifth of the rows with the lowest hashes of their columns.
SPLIT = """
, keyed_rows AS (
    SELECT carrier_code, hour_of_day, is_delayed AS label, "month",
        (DENSE_RANK() OVER (ORDER BY carrier_code) - 1)::DOUBLE AS carrier_enc, origin, dest,
        distance, day_of_week, day_of_month, "quarter", is_weekend,
        md5(concat_ws('|', carrier_code, origin, dest, distance::VARCHAR, hour_of_day::VARCHAR,
            day_of_week::VARCHAR, "month"::VARCHAR, day_of_month::VARCHAR, "quarter"::VARCHAR,
            is_weekend::VARCHAR, is_delayed::VARCHAR)) AS key
    FROM flights WHERE arr_delay_minutes IS NOT NULL
), placed AS (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY label ORDER BY key)
        <= floor(COUNT(*) OVER (PARTITION BY label) * 0.2e0) AS is_test
    FROM keyed_rows
), rates AS (
    SELECT carrier_enc, hour_of_day, AVG(label::DOUBLE) AS rate
    FROM placed WHERE NOT is_test GROUP BY ALL
), overall AS (
    SELECT AVG(label::DOUBLE) AS overall FROM placed WHERE NOT is_test
), scored AS (
    SELECT label, coalesce(rate, overall) AS p, (coalesce(rate, overall) > overall)::INTEGER AS guess
    FROM placed LEFT JOIN rates USING (carrier_enc, hour_of_day), overall WHERE is_test
)"""
SQL["m6_split_counts"] = (
    SPLIT + "SELECT label::DOUBLE AS label, is_test, COUNT(*) AS n FROM placed GROUP BY ALL"
)
SQL["m6_split_by_carrier"] = (
    SPLIT + """SELECT carrier_enc, "month", label::DOUBLE AS label, is_test, COUNT(*) AS n
FROM placed GROUP BY ALL"""
)
CLASS_ROWS = SPLIT + """
, classes AS (SELECT * FROM (VALUES (0, 'On-time'), (1, 'Delayed')) AS t(k, class)),
report AS (
    SELECT class, COUNT(*) FILTER (WHERE label = k AND guess = k) AS right_,
        COUNT(*) FILTER (WHERE guess = k) AS guessed, COUNT(*) FILTER (WHERE label = k) AS support
    FROM scored, classes GROUP BY class
), rated AS (
    SELECT *, right_ / guessed::DOUBLE AS precision, right_ / support::DOUBLE AS recall FROM report
), curve AS (
    SELECT p, SUM(hits) OVER w AS hits_so_far, SUM(misses) OVER w AS misses_so_far, hits, misses,
        SUM(hits) OVER () AS all_hits, SUM(misses) OVER () AS all_misses
    FROM (SELECT p, COUNT(*) FILTER (WHERE label = 1) AS hits,
                 COUNT(*) FILTER (WHERE label = 0) AS misses FROM scored GROUP BY p)
    WINDOW w AS (ORDER BY p DESC)
)"""
F1 = "2e0 * precision * recall / (precision + recall)"
SQL["m8_base_class_report"] = CLASS_ROWS + f"""
SELECT class, {rnd("precision", 9)} AS precision, {rnd("recall", 9)} AS recall, support,
    {rnd(F1, 9)} AS f1 FROM rated"""
SQL["m8_base_metrics"] = CLASS_ROWS + f"""
SELECT {rnd("(SELECT AVG((label = guess)::INTEGER::DOUBLE) FROM scored)", 9)} AS accuracy,
    {rnd("precision", 9)} AS precision, {rnd("recall", 9)} AS recall, {rnd(F1, 9)} AS f1,
    {rnd("(SELECT SUM(misses * (2 * hits_so_far - hits)) / (2e0 * MAX(all_hits) * MAX(all_misses)) FROM curve)", 9)}
        AS roc_auc
FROM rated WHERE class = 'Delayed'"""
SQL["m10_base_roc_curve"] = CLASS_ROWS + f"""
SELECT {rnd("p", 9)} AS threshold, {rnd("misses_so_far / all_misses::DOUBLE", 9)} AS false_positive_rate,
    {rnd("hits_so_far / all_hits::DOUBLE", 9)} AS true_positive_rate FROM curve"""
SQL["m11_base_confusion_matrix"] = CLASS_ROWS + f"""
SELECT label, prediction, n AS count, {rnd("n / SUM(n) OVER () * 100e0", 9)} AS pct FROM (
    SELECT a AS label, b AS prediction,
        COUNT(*) FILTER (WHERE scored.label = a AND guess = b) AS n
    FROM scored, (VALUES (0, 0), (0, 1), (1, 0), (1, 1)) AS t(a, b) GROUP BY ALL
)"""
SHUFFLED = [
    "Carrier", "Origin Airport", "Dest Airport", "Distance (mi)", "Hour of Day", "Hour (sin)",
    "Hour (cos)", "Day of Week", "DoW (sin)", "DoW (cos)", "Month", "Month (sin)", "Month (cos)",
    "Day of Month", "Quarter", "Is Weekend",
]
SQL["m12_base_permutation_importance"] = SPLIT + f"""
, ring AS (
    SELECT label, carrier_enc AS c, hour_of_day AS h,
        coalesce(lead(carrier_enc) OVER w, first_value(carrier_enc) OVER w) AS next_c,
        coalesce(lead(hour_of_day) OVER w, first_value(hour_of_day) OVER w) AS next_h
    FROM placed WHERE is_test WINDOW w AS (ORDER BY key)
), variants AS (
    SELECT 'none' AS v, label, c, h FROM ring
    UNION ALL SELECT 'Carrier', label, next_c, h FROM ring
    UNION ALL SELECT 'Hour of Day', label, c, next_h FROM ring
), points AS (
    SELECT v, coalesce(rate, overall) AS p, COUNT(*) FILTER (WHERE label = 1) AS hits,
        COUNT(*) FILTER (WHERE label = 0) AS misses
    FROM variants LEFT JOIN rates ON carrier_enc = c AND hour_of_day = h, overall GROUP BY ALL
), areas AS (
    SELECT v, SUM(misses * (2 * so_far - hits)) / (2e0 * SUM(hits) * SUM(misses)) AS area
    FROM (SELECT *, SUM(hits) OVER (PARTITION BY v ORDER BY p DESC) AS so_far FROM points)
    GROUP BY v
)
SELECT f.feature, {rnd("coalesce((SELECT area FROM areas WHERE v = 'none') - area, 0e0)", 9)} AS importance
FROM (SELECT unnest({SHUFFLED}) AS feature) f LEFT JOIN areas ON v = f.feature"""

# The forest.

FOREST = SPLIT + forest(trees=20, depth=8, min_leaf=50, tried=4, bins=64, seed=42)
NAMES = "[" + ", ".join(f"'{name}'" for name in SHUFFLED) + "]"
IMPORTANCE = f"""
, falls AS (
    SELECT t, f, SUM(gain * (n0 * k0 + n1 * k1)) AS fall FROM nodes, classes_weighed
    WHERE gain IS NOT NULL GROUP BY ALL
), shares AS (
    SELECT f, fall / SUM(fall) OVER (PARTITION BY t) AS share FROM falls
), gini AS (
    SELECT n.name, coalesce(SUM(share) / (SELECT COUNT(DISTINCT t) FROM falls), 0e0) AS importance
    FROM (SELECT unnest({NAMES}) AS name, unnest(range({len(SHUFFLED)})) AS f) n
    LEFT JOIN shares USING (f) GROUP BY n.name
)"""
SQL["m7_node_table"] = FOREST + f"""
SELECT t::INTEGER AS tree, node, level, n0, n1, ({NAMES})[f + 1] AS feature, b::INTEGER AS bin,
    {rnd("gain", 9)} AS gain FROM nodes"""
SQL["m7_fitted_forest"] = FOREST + IMPORTANCE + f"""
SELECT 20 AS trees, (SELECT COUNT(*) FROM nodes)::INTEGER AS nodes,
    {rnd("(SELECT SUM(importance) FROM gini)", 6)} AS importance_sum,
    (SELECT COUNT(*) FROM placed WHERE NOT is_test) AS train_rows"""
SQL["m9_feature_importance"] = FOREST + IMPORTANCE + f"""
SELECT name AS feature, {rnd("importance", 9)} AS importance FROM gini"""
SQL["m8_scores_by_carrier"] = FOREST + f"""
SELECT carrier_enc, "month", COUNT(*) AS n, {rnd("AVG(p)", 9)} AS mean_score FROM forest_scored GROUP BY ALL"""
for part in ("m8_{}metrics", "m8_{}class_report", "m10_{}roc_curve", "m11_{}confusion_matrix"):
    report = SQL[part.format("base_")].removeprefix(SPLIT)
    SQL[part.format("")] = FOREST + re.sub(r"\bscored\b", "forest_scored", report)
SQL["m12_permutation_importance"] = FOREST + permuted(20, 8) + f"""
SELECT n.name AS feature, {rnd("(SELECT area FROM areas WHERE v = -1) - area", 9)} AS importance
FROM areas JOIN (SELECT unnest({NAMES}) AS name, unnest(range({len(SHUFFLED)})) AS v) n USING (v)"""
SQL["m13_saved_metrics"] = SQL["m8_metrics"]

NOT_OVER_FLIGHTS = {
    "n0_classify_questions",
    "n0_classify_composed",
    "n0_classify_documents",
    "n0_classify_conversations",
    "n16_sample_questions",
}


def oracle_sql() -> dict[str, str]:
    return {
        name: sql if name in NOT_OVER_FLIGHTS else over_flights(sql) for name, sql in SQL.items()
    }
