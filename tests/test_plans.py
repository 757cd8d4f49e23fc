from __future__ import annotations

import datetime as dt
import itertools
import random

import pytest
from pyspark.sql import functions as F

from skyledger.functions import measures as m
from skyledger.functions.numeric import asc, desc, ratio, round_to
from skyledger.operators.connections import connections
from skyledger.operators.quantiles import count_values, quantile, whiskers
from skyledger.operators.sampling import sample_rows
from skyledger.operators.scoring import dense_rank_by, percentile_rank, position_by, rank_by
from skyledger.plans import advanced, bi, charts, explore, quality, questions, service
from skyledger.functions.fixed_values import SAMPLE_QUESTIONS
from skyledger.sources.driver_tables import DriverTables
from tests.conftest import SMALL, rows_of

DAY = dt.date(2023, 3, 15)


@pytest.fixture(scope="module")
def tables(spark):
    return DriverTables(spark, SMALL)


def test_rounding(spark):
    values = [(1.005,), (2.5,), (-2.5,), (0.125,), (-0.001,), (None,)]
    df = spark.createDataFrame(values, "x double")
    assert [r[0] for r in rows_of(df.select(round_to(F.col("x"), 2)))] == [
        1.0, 2.5, -2.5, 0.13, 0.0, None,
    ]


def test_averages_stay_doubles(make_flights):
    flights = make_flights([{"arr_delay": 20}] * 5 + [{"arr_delay": 0}] * 6)
    (row,) = flights.agg(m.delay_rate_arr15().alias("x")).collect()
    assert row.x == 45.45


def test_zero_divisor_gives_null(spark, make_flights):
    (row,) = explore.kpi_summary(make_flights([{"cancelled": 1}])).collect()
    assert row.delay_rate_pct is None and row.cancel_rate_pct == 100.0
    assert rows_of(spark.range(1).select(ratio(F.lit(1), F.lit(0)))) == [(None,)]
    assert explore.kpi_summary(make_flights([])).collect()[0].total_flights == 0


def test_measure_variants_differ(make_flights):
    """One on time, one delayed, one diverted, one cancelled."""
    flights = make_flights(
        [{"arr_delay": 0}, {"arr_delay": 60}, {}, {"cancelled": 1}]
    )
    (row,) = flights.agg(
        m.delay_rate_arr15().alias("arr15"),
        m.delay_rate_completed().alias("completed"),
        m.on_time_complement().alias("complement"),
        m.on_time_api().alias("api"),
        m.on_time_arr0().alias("arr0"),
        m.avg_delay_positive().alias("positive"),
        m.avg_delay_minutes().alias("minutes"),
    ).collect()
    assert tuple(row) == (25.0, 33.33, 75.0, 50.0, 25.0, 60.0, 30.0)


def test_ranks_and_null_order(spark):
    df = spark.createDataFrame([("a", 10), ("b", 10), ("c", 9)], "k string, v int")
    ranks = df.select(
        "k",
        rank_by(*desc("v")).alias("r"),
        dense_rank_by(*desc("v")).alias("d"),
        position_by(*desc("v"), *asc("k")).alias("p"),
    ).orderBy("k")
    assert rows_of(ranks) == [("a", 1, 1, 1), ("b", 1, 1, 2), ("c", 3, 2, 3)]
    df = spark.createDataFrame([(1, 1), (2, 2), (3, 2), (4, None)], "k int, v int")
    found = [r[1] for r in rows_of(df.select("k", percentile_rank("v")).orderBy("k"))]
    assert found == pytest.approx([0, 1 / 3, 1 / 3, 1])


def test_quantiles_from_counts_match_direct(spark):
    rng = random.Random(1)
    rows = [(rng.choice("ab"), float(rng.randint(-5, 40))) for _ in range(500)] + [("a", None)]
    df = spark.createDataFrame(rows, "k string, v double")
    counted = count_values(df, ["k"], "v").groupBy("k").agg(
        *[quantile("v", p).alias(f"p{i}") for i, p in enumerate((0.01, 0.5, 0.95))]
    )
    direct = df.groupBy("k").agg(
        *[F.percentile("v", F.lit(p)).alias(f"p{i}") for i, p in enumerate((0.01, 0.5, 0.95))]
    )
    assert sorted(rows_of(counted)) == sorted(rows_of(direct))


def test_box_whiskers(spark):
    df = spark.createDataFrame([(float(v),) for v in (1, 2, 3, 4, 100)], "v double")
    box = count_values(df, [], "v").agg(
        quantile("v", 0.25).alias("q1"),
        quantile("v", 0.5).alias("med"),
        quantile("v", 0.75).alias("q3"),
        F.min("v").alias("lo"),
        F.max("v").alias("hi"),
    )
    low, high = whiskers("q1", "q3", "lo", "hi")
    assert rows_of(box.select("q1", "med", "q3", low, high)) == [(2.0, 3.0, 4.0, 1.0, 7.0)]


def test_rolling_windows(make_flights):
    days = [DAY + dt.timedelta(days=i) for i in range(8)]
    flights = make_flights(
        [{"flight_date": d, "arr_delay": 20 if i % 2 else 0} for i, d in enumerate(days)]
    )
    rows = advanced.rolling_delay(flights).collect()
    assert [r.rolling_7d_delay_rate for r in rows[:3]] == [0.0, 50.0, 33.33]
    ma7 = [r.ma7 for r in charts.daily_volume(flights).collect()]
    assert ma7 == [None, None, None, 1.0, 1.0, None, None, None]


def test_year_over_year_row_lag_and_calendar(make_flights):
    """Thirteen months without one: the row lag and the calendar join disagree."""
    months = [(2022, k) for k in range(1, 13) if k != 5] + [(2023, 1), (2023, 2)]
    flights = make_flights(
        [
            {"flight_date": dt.date(y, k, 1), "arr_delay": 10 * k + (y - 2022) * 5}
            for y, k in months
        ]
    )
    by_row = {(r.year, r.month): r for r in advanced.year_over_year(flights).collect()}
    assert by_row[(2023, 1)].py_flights is None
    assert by_row[(2023, 1)].yoy_trend == "No prior year"
    assert by_row[(2023, 1)].yoy_avg_delay_change == 15.0
    assert by_row[(2023, 2)].py_flights == 1
    calendar = {(r.year, r.month): r for r in bi.yoy_delay_change(flights).collect()}
    assert calendar[(2023, 1)].yoy_delay_change == 0.5
    assert calendar[(2022, 1)].yoy_delay_change == 0.0


def test_one_month_has_no_slope(make_flights, carriers):
    flights = make_flights([{"flight_date": DAY, "carrier_code": "DL", "arr_delay": 1}])
    (row,) = advanced.carrier_momentum(flights, carriers).collect()
    assert row.trend_slope is None and row.trend_direction == "Stable"


def test_severity_edges_and_empty_bucket(make_flights):
    flights = make_flights([{"arr_delay": v} for v in (0, 15, 16, 60, 61)])
    counts = {r.severity: r.cnt for r in charts.severity_breakdown(flights).collect()}
    assert counts == {
        "On-time / Early": 1,
        "Minor (1-15)": 1,
        "Moderate (16-60)": 2,
        "Severe (61-120)": 1,
        "Extreme (>120)": None,
    }


def test_unknown_carrier(make_flights, carriers):
    flights = make_flights(
        [{"carrier_code": c, "arr_delay": 0, "flight_date": DAY} for c in ("DL", "ZZ")]
    )
    kept = explore.carrier_on_time(flights, carriers, min_flights=1).collect()
    assert {r.carrier_code for r in kept} == {"DL", "ZZ"}
    dropped = service.carrier_ranking(flights, carriers).collect()
    assert {r.carrier_code for r in dropped} == {"DL"}


def test_arguments_are_checked(make_flights):
    flights = make_flights([])
    with pytest.raises(ValueError):
        service.top_routes(flights, sort="sideways")
    with pytest.raises(ValueError):
        service.top_routes(flights, limit=0)


def test_sample_questions(spark):
    asked = questions.with_intent(questions.sample_questions(spark), "question")
    assert [r.intent for r in asked.orderBy("question_id").collect()] == [
        "best_airline", "delay_causes", "peak_delay_hours", "monthly_trends",
        "airport_comparison", "cancellation_info", "weather_delays", "busiest_airport",
        "route_analysis", "general_stats",
    ]


def test_intents_follow_python_search(spark):
    import re

    from skyledger.functions.fixed_values import FALLBACK_INTENT, INTENT_PATTERNS

    texts = [
        *SAMPLE_QUESTIONS, "", "   ", "What is the reason weather delays trend up?",
        "bestä airline", "best\nairline", "BEST of all AIRLINE", "most on-time", "mostontime",
        "worst\rtime", "leastdelay", "least delay", "origin to destination", "how  many",
    ]

    def expected(text):
        lowered = text.lower().strip()
        for intent, patterns in INTENT_PATTERNS.items():
            if any(re.search(p, lowered) for p in patterns):
                return intent
        return FALLBACK_INTENT

    df = spark.createDataFrame([(t,) for t in texts], "text string")
    found = {r.text: r.intent for r in questions.with_intent(df, "text").collect()}
    assert found == {t: expected(t) for t in texts}


def test_answers_for_no_flights(spark, make_flights, carriers):
    answers = {r.intent: r.answer for r in questions.answers(make_flights([]), carriers).collect()}
    assert len(answers) == 13
    assert answers["best_airline"].endswith("No data found for your query.")
    assert answers["monthly_trends"].endswith("No data found for your query.")


def naive_connections(flights, best=3, max_legs=2):
    """Every itinerary of a small list of flights, ranked."""
    found = []
    level = [(f["flight_date"], f["origin"], f["dest"], f"{f['origin']}-{f['dest']}", 1,
              f["arr_time"], f["arr_delay"]) for f in flights]
    for legs in range(1, max_legs + 1):
        found += level
        level = [
            (day, start, f["dest"], f"{path} -> {f['dest']}", legs + 1, f["arr_time"],
             None if total is None else total + (f["arr_delay"] or 0))
            for day, start, at, path, _, arrived, total in level
            for f in flights
            if f["flight_date"] == day and f["origin"] == at and f["dep_time"] > arrived + 60
        ]
    out = []
    key = lambda r: (r[0], r[1], r[2])
    for group, rows in itertools.groupby(sorted(found, key=key), key):
        ranked = sorted(rows, key=lambda r: (r[6] is None, r[6] or 0, r[4], r[3]))[:best]
        out += [(*group, r[3], r[4], r[6], i + 1) for i, r in enumerate(ranked)]
    return sorted(out, key=str)


@pytest.mark.parametrize("max_legs", [1, 2, 3])
@pytest.mark.parametrize("seed", range(3))
def test_connections_match_brute_force(make_flights, seed, max_legs):
    rng = random.Random(seed)
    flights = []
    for _ in range(110):
        # One hub takes a third of all flights.
        a, b = rng.sample(["AAA", "BBB", "CCC", "DDD"], 2)
        if rng.random() < 0.33:
            a, b = "AAA", "HUB"
        elif rng.random() < 0.4:
            a = "HUB"
        leaves = rng.randint(5, 21) * 100 + rng.randint(0, 59)
        flights.append(
            {
                "flight_date": DAY + dt.timedelta(days=rng.randint(0, 1)),
                "origin": a,
                "dest": b,
                "dep_time": float(leaves),
                "arr_time": float(leaves + rng.choice([30, 100, 160])),
                "arr_delay": None if rng.random() < 0.05 else float(rng.randint(-20, 25)),
            }
        )
    got = connections(make_flights(flights), origin=None, date=None, max_legs=max_legs)
    assert sorted(rows_of(got), key=str) == naive_connections(flights, max_legs=max_legs)


def test_connection_gap_is_strict(make_flights):
    def leg(a, b, leaves, arrives):
        return {"flight_date": DAY, "origin": a, "dest": b, "dep_time": leaves,
                "arr_time": arrives, "arr_delay": 0}

    flights = make_flights(
        [leg("ATL", "X", 1300, 1350), leg("X", "Y", 1410, 1500), leg("X", "Z", 1411, 1500),
         leg("Z", "W", 1700, 1800)]
    )
    assert {r.path for r in connections(flights).collect()} == {"ATL-X", "ATL-X -> Z"}
    minutes = connections(flights, clock_minutes=True, min_connect=20).collect()
    assert {r.path for r in minutes} == {"ATL-X", "ATL-X -> Z"}
    three = connections(flights, max_legs=3).collect()
    assert "ATL-X -> Z -> W" in {r.path for r in three}


def test_sample_has_the_size_asked_for(spark):
    df = spark.range(20_000).repartition(7)
    assert sample_rows(df, 500, 1).distinct().count() == 500
    assert sample_rows(df, 50_000, 1).count() == 20_000


def test_invariants(tables):
    flights = tables.flights
    n = flights.count()
    (kpi,) = service.overview(flights).collect()
    assert kpi.on_time_pct + kpi.delay_pct + kpi.cancel_pct == pytest.approx(100, abs=0.02)
    buckets = advanced.severity_distribution(flights).collect()
    assert sum(r.flights for r in buckets) == flights.filter("arr_delay IS NOT NULL").count()
    assert buckets[-1].cumulative_pct == 100.0
    causes = service.delay_causes(flights).collect()
    assert sum(r.percentage for r in causes) == pytest.approx(100, abs=0.05)
    assert sum(r.flights for r in charts.hourly_profile(flights).collect()) == n


def test_results_do_not_depend_on_partitions(spark, tables):
    flights = tables.flights
    before = spark.conf.get("spark.sql.shuffle.partitions")

    def results():
        return [
            sorted(map(str, rows_of(plan)))
            for plan in (
                advanced.route_severity(flights, tables.airports, min_flights=5),
                advanced.carrier_momentum(flights, tables.carriers),
                connections(flights, origin=None, date=None),
            )
        ]

    try:
        spark.conf.set("spark.sql.shuffle.partitions", "1")
        one = results()
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        assert results() == one
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_one_scan_and_pruned_columns(tables):
    flights = tables.flights
    for df in (
        explore.delay_causes(flights),
        quality.null_profile(flights),
        service.delay_causes(flights),
        advanced.hub_efficiency(flights, tables.airports.limit(0)),
        advanced.route_decomposition(flights),
        questions.insights(flights, tables.carriers),
        advanced.cancellations_by_season(flights, tables.calendar),
    ):
        plan = plan_of(df)
        assert plan.count("year=") == 0
        assert sum("/flights-" in line for line in plan.splitlines()) == 1, plan
    plan = plan_of(explore.delay_by_hour(flights))
    pushed = plan.split("PushedFilters: [")[1].split("], ReadSchema")[0]
    assert "EqualTo(cancelled,0)" in pushed and "IsNotNull(hour_of_day)" in pushed
    assert "origin" not in plan.split("ReadSchema")[1]


def test_limits_apply_before_the_shuffle(tables):
    plan = plan_of(connections(tables.flights, origin=None, date=None))
    assert "row_number(), 3, Partial" in plan
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
