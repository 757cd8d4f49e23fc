"""Names, labels, patterns and texts that results must carry verbatim."""

from __future__ import annotations

# Carrier code -> carrier name.
CARRIER_NAMES = {
    "9E": "Endeavor Air",
    "AA": "American Airlines",
    "AS": "Alaska Airlines",
    "B6": "JetBlue Airways",
    "DL": "Delta Air Lines",
    "F9": "Frontier Airlines",
    "G4": "Allegiant Air",
    "HA": "Hawaiian Airlines",
    "MQ": "Envoy Air",
    "NK": "Spirit Airlines",
    "OH": "PSA Airlines",
    "OO": "SkyWest Airlines",
    "UA": "United Airlines",
    "WN": "Southwest Airlines",
    "YX": "Republic Airways",
}

# Raw file header -> column of the flights table.
RAW_TO_COLUMN = {
    "YEAR": "year",
    "MONTH": "month",
    "DAY_OF_MONTH": "day_of_month",
    "DAY_OF_WEEK": "day_of_week",
    "FL_DATE": "flight_date",
    "OP_UNIQUE_CARRIER": "carrier_code",
    "ORIGIN": "origin",
    "ORIGIN_CITY_NAME": "origin_city",
    "ORIGIN_STATE_ABR": "origin_state",
    "DEST": "dest",
    "DEST_CITY_NAME": "dest_city",
    "DEST_STATE_ABR": "dest_state",
    "CRS_DEP_TIME": "crs_dep_time",
    "DEP_TIME": "dep_time",
    "DEP_DELAY": "dep_delay",
    "DEP_DELAY_NEW": "dep_delay_minutes",
    "CRS_ARR_TIME": "crs_arr_time",
    "ARR_TIME": "arr_time",
    "ARR_DELAY": "arr_delay",
    "ARR_DELAY_NEW": "arr_delay_minutes",
    "CANCELLED": "cancelled",
    "CANCELLATION_CODE": "cancellation_code",
    "DISTANCE": "distance",
    "CARRIER_DELAY": "carrier_delay",
    "WEATHER_DELAY": "weather_delay",
    "NAS_DELAY": "nas_delay",
    "SECURITY_DELAY": "security_delay",
    "LATE_AIRCRAFT_DELAY": "late_aircraft_delay",
}

# Cause column -> label, in the order that breaks ties.
CAUSE_LABELS = {
    "carrier_delay": "Carrier",
    "weather_delay": "Weather",
    "nas_delay": "NAS",
    "security_delay": "Security",
    "late_aircraft_delay": "Late Aircraft",
}

# Names by number (weekday 1 is Monday).
DAY_NAMES = {
    1: "Monday",
    2: "Tuesday",
    3: "Wednesday",
    4: "Thursday",
    5: "Friday",
    6: "Saturday",
    7: "Sunday",
}
DAY_ABBREVIATIONS = {1: "Mon", 2: "Tue", 3: "Wed", 4: "Thu", 5: "Fri", 6: "Sat", 7: "Sun"}
MONTH_ABBREVIATIONS = {
    1: "Jan", 2: "Feb", 3: "Mar", 4: "Apr", 5: "May", 6: "Jun",
    7: "Jul", 8: "Aug", 9: "Sep", 10: "Oct", 11: "Nov", 12: "Dec",
}

# Season of each month.
SEASON_MONTHS = {"Winter": (12, 1, 2), "Spring": (3, 4, 5), "Summer": (6, 7, 8), "Fall": (9, 10, 11)}

# Cancellation reasons. The wording of code C differs by report.
CANCELLATION_REASONS = {"A": "Carrier", "B": "Weather", "C": "NAS", "D": "Security"}
CANCELLATION_REASONS_QUALITY = CANCELLATION_REASONS | {"C": "NAS (National Aviation System)"}
CANCELLATION_REASONS_SEASON = CANCELLATION_REASONS | {"C": "NAS (National Airspace System)"}

# Arrival delay buckets as (inclusive upper bound, label).
DELAY_BUCKETS = [
    (-15, "01: >15min Early"),
    (0, "02: On Time / Early"),
    (15, "03: 1-15min Late"),
    (30, "04: 16-30min Late"),
    (60, "05: 31-60min Late"),
    (120, "06: 61-120min Late"),
    (240, "07: 121-240min Late"),
    (None, "08: 240+min Late"),
]
SEVERITY_BUCKETS = [
    (0, "On-time / Early"),
    (15, "Minor (1-15)"),
    (60, "Moderate (16-60)"),
    (120, "Severe (61-120)"),
    (None, "Extreme (>120)"),
]

# Congestion tier of each delay quintile.
CONGESTION_TIERS = {
    1: "Excellent",
    2: "Good",
    3: "Average",
    4: "Congested",
    5: "Severely Congested",
}

# Weights of the two composite scores.
CONGESTION_WEIGHTS = {
    "dep_delay_rate_pct": 0.40,
    "avg_dep_delay": 0.30,
    "p90_dep_delay": 0.20,
    "cancel_rate_pct": 0.10,
}
SEVERITY_WEIGHTS = {
    "delay_rate_pct": 0.30,
    "avg_delay_when_late": 0.25,
    "p95_arr_delay": 0.20,
    "cancel_rate_pct": 0.15,
    "stddev_arr_delay": 0.10,
}

# Airports compared side by side by default.
MAJOR_HUBS = [
    "ATL", "ORD", "DFW", "DEN", "LAX", "CLT", "SFO", "JFK",
    "SEA", "EWR", "MIA", "IAH", "PHX", "BOS", "MSP",
]

# ISO week numbers that get a label, and holiday windows of 2023.
WEEK_LABELS = {
    1: "New Year",
    7: "Valentine's",
    9: "Presidents' Day",
    13: "Spring Break",
    18: "Memorial Day",
}
HOLIDAY_WINDOWS = [
    ("New Year\n(Dec 31 - Jan 3)", "2023-01-01", "2023-01-03"),
    ("MLK Weekend\n(Jan 13-16)", "2023-01-13", "2023-01-16"),
    ("Presidents' Day\n(Feb 17-20)", "2023-02-17", "2023-02-20"),
    ("Spring Break\n(Mar 10-19)", "2023-03-10", "2023-03-19"),
    ("Memorial Day\n(May 26-29)", "2023-05-26", "2023-05-29"),
]

# Question intents in matching order, with their patterns, the
# opening sentence of the answer and the chart that suits it.
INTENT_PATTERNS = {
    "best_airline": [
        r"best\b.*airline", r"least\b.*delay", r"top.*airline", r"most.*on.?time",
        r"punctual", r"airline.*least", r"which.*airline.*best", r"airline.*best",
    ],
    "worst_airline": [
        r"worst\b.*airline", r"most\b.*delay.*airline", r"worst.*carrier",
        r"highest.*delay.*airline",
    ],
    "airline_ranking": [
        r"airline.*rank", r"rank.*airline", r"carrier.*rank", r"compare.*airline",
        r"airline.*performance",
    ],
    "peak_delay_hours": [
        r"peak.*hour", r"busiest.*hour", r"worst.*time", r"best.*time.*fly",
        r"hour.*delay", r"delay.*hour", r"time.*day",
    ],
    "delay_causes": [r"cause", r"reason.*delay", r"why.*delay", r"delay.*because", r"what.*cause"],
    "weather_delays": [r"weather"],
    "airport_comparison": [
        r"airport.*compar", r"airport.*delay", r"delay.*airport",
        r"which.*airport.*worst", r"which.*airport.*best",
    ],
    "busiest_airport": [
        r"busiest.*airport", r"most.*flights.*airport", r"largest.*airport",
        r"airport.*volume", r"airport.*traffic",
    ],
    "cancellation_info": [r"cancel", r"cancell"],
    "monthly_trends": [r"monthly.*trend", r"trend", r"month"],
    "seasonal": [r"season", r"day.*week", r"weekday", r"weekend"],
    "route_analysis": [r"route", r"origin.*dest", r"city.*pair"],
    "general_stats": [r"overview", r"summary", r"general", r"stats", r"statistic", r"how many"],
}
FALLBACK_INTENT = "general_stats"
INTENT_OPENINGS = {
    "best_airline": "Here are the airlines ranked from best to worst on-time performance:",
    "worst_airline": "Here are the airlines with the highest delay rates:",
    "airline_ranking": "Here is the full airline ranking by on-time performance:",
    "peak_delay_hours": "Here is the delay pattern across different hours of the day:",
    "delay_causes": "Here is the breakdown of delay causes by total minutes:",
    "weather_delays": "Here is the weather delay analysis by season:",
    "airport_comparison": "Here are the airports compared by delay rate:",
    "busiest_airport": "Here are the busiest airports by flight volume:",
    "cancellation_info": "Here is the cancellation breakdown by reason:",
    "monthly_trends": "Here are the monthly delay trends:",
    "seasonal": "Here are the seasonal delay patterns:",
    "route_analysis": "Here are the routes with the highest delay rates:",
    "general_stats": "Here is a general overview of the flight dataset:",
}
INTENT_CHARTS = {
    "best_airline": "bar",
    "worst_airline": "bar",
    "airline_ranking": "bar",
    "peak_delay_hours": "line",
    "delay_causes": "pie",
    "weather_delays": "bar",
    "airport_comparison": "bar",
    "busiest_airport": "bar",
    "cancellation_info": "pie",
    "monthly_trends": "line",
    "seasonal": "bar",
    "route_analysis": "bar",
    "general_stats": "kpi",
}
NO_DATA = "No data found for your query."
SAMPLE_QUESTIONS = [
    "Which airline has the best on-time performance?",
    "What are the main causes of flight delays?",
    "Which hours have the worst delays?",
    "Show me monthly delay trends",
    "Which airports have the highest delay rate?",
    "What is the cancellation breakdown?",
    "How does weather affect delays?",
    "What are the busiest airports?",
    "Show me the worst routes for delays",
    "Give me an overview of all flights",
]
