"""Every query by name, over the driver's tables.

Thresholds that would leave nothing at test scale are bound lower here; the
functions keep their published defaults.  The oracle SQL uses the same values.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.functions.fixed_values import SAMPLE_QUESTIONS
from skyledger.functions.numeric import round_to
from skyledger.operators.connections import connections
from skyledger.operators.trees import Growth
from skyledger.plans import (
    advanced,
    bi,
    charts,
    delay_model,
    explore,
    exports,
    quality,
    questions,
    reports,
    rollups,
    service,
    states,
)
from skyledger.session import run_sql, work_path, write_shared
from skyledger.sources import raw_flights
from skyledger.sources.dimensions import (
    airports_from_csv,
    calendar_dimension,
    carrier_dimension,
)
from skyledger.sources.driver_tables import (
    DriverTables,
    raw_text,
    write_airports_file,
    write_raw_files,
)
from skyledger.sources.schema import SOURCE_COLUMNS
from skyledger.sources.sinks import read_flights, replace_months, write_flights, write_table

AIRPORT_MIN_FLIGHTS = 2000
ROUTE_MIN_FLIGHTS = 100
SEVERITY_MIN_FLIGHTS = 50
HUBS = 10
NAMED_HUBS = [f"N{key:02d}" for key in range(15)]
# Names of the travel windows; the dates are those of the test tables.
WINDOWS = [
    ("New Year", "1998-01-01", "1998-01-03"),
    ("MLK Weekend", "1998-01-16", "1998-01-19"),
    ("Presidents' Day", "1998-02-13", "1998-02-16"),
    ("Spring Break", "1998-03-13", "1998-03-22"),
    ("Memorial Day", "1998-05-22", "1998-05-25"),
]
FOREST = Growth(trees=20, depth=8)

Query = Callable[[DriverTables], DataFrame]


def _flags_as_double(df: DataFrame) -> DataFrame:
    """The two three-valued flags as doubles, so that a null reads alike in every client."""
    flags = {c: F.col(c).cast("double") for c in ("arr_del15", "dep_del15") if c in df.columns}
    return df.withColumns(flags)


def raw_csv_files(t: DriverTables) -> DataFrame:
    """Raw files of three headers and five date layouts, with bad numbers, read and cleaned."""
    path = work_path(t.spark, "raw-csv")
    write_raw_files(t.flights, path)
    return raw_flights.clean(raw_flights.read_raw_csv(t.spark, path)).select(*SOURCE_COLUMNS)


def airports_csv_file(t: DriverTables) -> DataFrame:
    path = work_path(t.spark, "airports-csv")
    write_airports_file(t.airports, path)
    return airports_from_csv(t.spark, path)


def clean_raw_text(t: DriverTables) -> DataFrame:
    return raw_flights.clean(raw_text(t.flights)).select(*SOURCE_COLUMNS)


def derived_columns(t: DriverTables) -> DataFrame:
    return _flags_as_double(
        t.flights.select(
            "flight_date", "carrier_code", "origin", "dest", "crs_dep_time", "arr_delay",
            "dep_delay", "arr_del15", "dep_del15", "hour_of_day", "is_weekend", "route",
            "quarter", "is_delayed", "primary_delay_cause",
        )
    )


def parquet_by_month(t: DriverTables) -> DataFrame:
    path = work_path(t.spark, "flights")
    write_flights(t.flights, path)
    return _flags_as_double(read_flights(t.spark, path))


def reloaded_month(t: DriverTables) -> DataFrame:
    """Every March loaded again without its cancelled flights, over a table of all months."""
    path = work_path(t.spark, "flights")
    write_flights(t.flights, path)
    replace_months(t.flights.where("month = 3 AND cancelled = 0"), path)
    return _flags_as_double(read_flights(t.spark, path))


def csv_export_reread(t: DriverTables) -> DataFrame:
    """The whole fact out as CSV and back in through a declared schema."""
    path = work_path(t.spark, "flights-csv")
    flights = t.flights
    write_table(flights, path, "csv")
    return _flags_as_double(t.spark.read.csv(path, header=True, schema=flights.schema))


def capped_sql(t: DriverTables) -> DataFrame:
    view = f"skyledger_flights_{uuid.uuid4().hex}"
    t.flights.createOrReplaceTempView(view)
    return run_sql(
        t.spark,
        "SELECT origin, count(*) AS flights, max(arr_delay) AS longest"
        f" FROM {view} WHERE arr_delay >= :minutes"
        " GROUP BY origin ORDER BY flights DESC, origin",
        {"minutes": 60},
        max_rows=5,
    )


def dataset_csv_reread(t: DriverTables) -> DataFrame:
    path = work_path(t.spark, "carriers-csv")
    exports.export_dataset("carriers", path, t.flights, t.carriers, t.airports, "csv")
    schema = exports.carriers_dataset(t.flights, t.carriers, t.airports).schema
    return t.spark.read.csv(path, header=True, schema=schema)


def dataset_json_reread(t: DriverTables) -> DataFrame:
    path = work_path(t.spark, "trends-json")
    exports.export_dataset("trends", path, t.flights, t.carriers, t.airports, "json")
    schema = exports.trends(t.flights, t.carriers, t.airports).schema
    return t.spark.read.schema(schema).json(path)


def _report_reread(table: str) -> Query:
    """The whole report written, and one of its tables read back."""

    def read(t: DriverTables) -> DataFrame:
        folder = work_path(t.spark, "report")
        paths = exports.export_report(folder, t.flights, t.carriers, t.airports, "parquet")
        return t.spark.read.parquet(next(p for p in paths if p.endswith(f"/{table}")))

    return read


def _view(place: int) -> Query:
    """One of the three views, under names of its own so that no view of a user is replaced."""

    def read(t: DriverTables) -> DataFrame:
        names = rollups.install_views(t.flights, t.carriers, prefix="skyledger_v_")
        return t.spark.table(names[place])

    return read


def asked(t: DriverTables) -> DataFrame:
    """One question per event: the sample questions in turn, by event number."""
    texts = F.array(*[F.lit(text) for text in SAMPLE_QUESTIONS])
    place = (F.col("event_id") % len(SAMPLE_QUESTIONS)).cast("int") + 1
    return t.read("events").select(
        F.col("event_id").alias("question_id"), F.element_at(texts, place).alias("question")
    )


# Phrases that parts' names and types are put around, so that every intent is asked for.
PHRASES = (
    "best airline for", "worst carrier of", "rank every airline by", "busiest hour of", "cause of",
    "weather and", "airport delay near", "largest airport for", "cancelled", "monthly trend of",
    "season of", "city pair for", "how many",
)


def classify_composed(t: DriverTables) -> DataFrame:
    """Questions composed of a phrase and the words of a part."""
    phrases = F.array(*[F.lit(p) for p in PHRASES])
    phrase = F.element_at(phrases, (F.col("p_partkey") % len(PHRASES)).cast("int") + 1)
    text = F.concat_ws(" ", "p_name", phrase, "p_type", F.lower("p_brand"))
    asked_for = t.read("part").select("p_partkey", text.alias("text"))
    return questions.with_intent(asked_for, "text").select("p_partkey", "intent")


def classify_questions(t: DriverTables) -> DataFrame:
    return questions.with_intent(asked(t), "question")


def classify_documents(t: DriverTables) -> DataFrame:
    return questions.with_intent(t.read("documents"), "text").select("doc_id", "intent")


def classify_conversations(t: DriverTables) -> DataFrame:
    classified = questions.with_intent(t.read("conversations"), "text")
    return classified.select("conv_id", "turn", "intent")


def sample_question_use(t: DriverTables) -> DataFrame:
    sample = questions.sample_questions(t.spark).select("question")
    counts = asked(t).groupBy("question").agg(F.count(F.lit(1)).alias("asked"))
    return sample.join(counts, "question")


def _intent(name: str) -> Query:
    return lambda t: questions.INTENT_ROWS[name](t.flights, t.carriers, t.airports, t.calendar)


def _dataset(name: str) -> Query:
    return lambda t: exports.dataset(name, t.flights, t.carriers, t.airports)


def features(t: DriverTables) -> DataFrame:
    rows = delay_model.engineer(delay_model.modelling_rows(t.flights)).drop("key")
    cycles = [c for c in rows.columns if c.endswith(("_sin", "_cos"))]
    return rows.withColumns({c: round_to(F.col(c), 6) for c in cycles})


_made: dict[tuple, object] = {}


def _once(t: DriverTables, name: str, make: Callable[[], object]):
    """Made once per session and state of the tables: the model line builds on written rows."""
    key = (name, *t.state("model"))
    if key not in _made:
        _made[key] = make()
    return _made[key]


def _prepared(t: DriverTables) -> DataFrame:
    return _once(t, "rows", lambda: delay_model.prepare(t.flights))


def _sides(t: DriverTables) -> tuple[DataFrame, DataFrame]:
    return delay_model.split(_prepared(t))


def _forest(t: DriverTables):
    return _once(t, "forest", lambda: delay_model.grow_forest(_sides(t)[0], FOREST))


def _scored(t: DriverTables) -> DataFrame:
    """All test rows as the forest scores them, written once."""

    def make() -> DataFrame:
        scored = delay_model.trees_scorer(_forest(t))(_sides(t)[1])
        return write_shared(scored.select("label", "prediction", "probability"), "scored")[0]

    return _once(t, "scored", make)


def _base_scored(t: DriverTables) -> DataFrame:
    """All test rows as the late share by carrier and hour scores them."""
    train, test = _sides(t)
    scorer = delay_model.late_share_scorer(train)
    return scorer(test).select("label", "prediction", "probability")


def split_counts(t: DriverTables) -> DataFrame:
    return _prepared(t).groupBy("label", "is_test").agg(F.count(F.lit(1)).alias("n"))


def split_by_carrier(t: DriverTables) -> DataFrame:
    """Rows of each side by carrier and month: which rows fall where."""
    keys = ["carrier_enc", "month", "label", "is_test"]
    return _prepared(t).groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


def _rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: round_to(F.col(c), 9) for c in columns})


def fitted_forest(t: DriverTables) -> DataFrame:
    """Size of the fitted forest, rows it could learn from, and the sum of its importances."""
    forest = _forest(t)
    train, _ = _sides(t)
    gini = delay_model.tree_importance(t.spark, forest).agg(F.sum("importance")).scalar()
    return train.agg(F.count(F.lit(1)).alias("train_rows")).select(
        F.lit(forest.trees).alias("trees"),
        F.lit(len(forest.node)).alias("nodes"),
        round_to(gini, 6).alias("importance_sum"),
        "train_rows",
    )


def scores_by_carrier(t: DriverTables) -> DataFrame:
    """Held-out rows and their mean score by carrier and month."""
    scored = delay_model.trees_scorer(_forest(t))(_sides(t)[1])
    means = scored.groupBy("carrier_enc", "month").agg(
        F.count(F.lit(1)).alias("n"), F.avg("probability").alias("mean_score")
    )
    return _rounded(means, "mean_score")


def _states(t: DriverTables) -> str:
    """States of all months, each in two parts; then one month is loaded again, whole."""

    def make() -> str:
        path = work_path(t.spark, "states")
        states.load(t.flights.where("day_of_month % 2 = 0"), path)
        states.load(t.flights.where("day_of_month % 2 = 1 OR day_of_month IS NULL"), path, add=True)
        states.load(t.flights.where("month = 5"), path)
        return path

    return _once(t, "states", make)


def saved_metrics(t: DriverTables) -> DataFrame:
    path = work_path(t.spark, "metrics")
    one_row = delay_model.metrics(_scored(t))
    delay_model.save_metrics(one_row, path)
    return _rounded(t.spark.read.csv(path, header=True, schema=one_row.schema), *one_row.columns)


def permutation_importance(t: DriverTables) -> DataFrame:
    scorer = delay_model.trees_scorer(_forest(t))
    return _rounded(delay_model.permutation_importance(scorer, _sides(t)[1]), "importance")


def base_permutation(t: DriverTables) -> DataFrame:
    train, test = _sides(t)
    scorer = delay_model.late_share_scorer(train)
    return _rounded(delay_model.permutation_importance(scorer, test), "importance")


QUERIES: dict[str, Query] = {
    # Sources, sinks and dimensions
    "s1_s5_clean_raw_text": clean_raw_text,
    "s1_s5_raw_csv_files": raw_csv_files,
    "s6_s10_derived_columns": derived_columns,
    "s11_s12_parquet_by_month": parquet_by_month,
    "s11_s12_reloaded_month": reloaded_month,
    "s13_airports": lambda t: t.airports,
    "s13_airports_csv_file": airports_csv_file,
    "s14_carriers": lambda t: carrier_dimension(t.flights, t.carriers),
    "s15_calendar": lambda t: calendar_dimension(t.flights),
    "s16_view_of_airports": _view(0),
    "s16_view_of_carriers": _view(1),
    "s16_view_of_routes": _view(2),
    "s17_load_profile": lambda t: quality.load_profile(t.flights),
    "s17_flights_by_month": lambda t: quality.load_flights_by_month(t.flights),
    "s17_top_origins": lambda t: quality.load_top_origins(t.flights),
    "s17_top_carriers": lambda t: quality.load_top_carriers(t.flights, t.carriers),
    "s18_csv_export_reread": csv_export_reread,
    "s21_dataset_csv_reread": dataset_csv_reread,
    "s22_dataset_json_reread": dataset_json_reread,
    "s24_report_table_reread": _report_reread("Carrier_Performance"),
    "s24_summary_reread": _report_reread("Summary"),
    "s24_hourly_reread": _report_reread("Hourly_Delays"),
    "s24_airports_reread": _report_reread("Airport_Performance"),
    "s24_monthly_reread": _report_reread("Monthly_Trends"),
    "s24_causes_reread": _report_reread("Delay_Causes"),
    "s25_capped_sql": capped_sql,
    # Rollups
    "v1_daily_airport_summary": lambda t: rollups.daily_airport_summary(t.flights),
    "v2_monthly_carrier_performance": lambda t: rollups.monthly_carrier_performance(
        t.flights, t.carriers
    ),
    "v3_route_reliability": lambda t: rollups.route_reliability(t.flights),
    "v1_from_states": lambda t: states.daily_airport_summary(t.spark, _states(t)),
    "v2_from_states": lambda t: states.monthly_carrier_performance(t.spark, _states(t), t.carriers),
    "v3_from_states": lambda t: states.route_reliability(t.spark, _states(t)),
    # Quality
    "q1_volume_by_month": lambda t: quality.volume_by_month(t.flights),
    "q2_null_profile": lambda t: quality.null_profile(t.flights),
    "q3_delay_distribution": lambda t: quality.delay_distribution(t.flights),
    "q4_cancellation_codes": lambda t: quality.cancellation_codes(t.flights),
    "q5_orphan_airports": lambda t: quality.orphan_airports(t.flights, t.airports),
    "q6_daily_volume_distribution": lambda t: quality.daily_volume_distribution(t.flights),
    # Exploratory
    "x1_kpi_summary": lambda t: explore.kpi_summary(t.flights),
    "x2_delay_by_hour": lambda t: explore.delay_by_hour(t.flights),
    "x3_delay_by_day_of_week": lambda t: explore.delay_by_day_of_week(t.flights),
    "x4_delay_by_month": lambda t: explore.delay_by_month(t.flights),
    "x5_busiest_airports": lambda t: explore.busiest_airports(t.flights, t.airports),
    "x6_most_delayed_airports": lambda t: explore.most_delayed_airports(
        t.flights, t.airports, AIRPORT_MIN_FLIGHTS
    ),
    "x7_carrier_on_time": lambda t: explore.carrier_on_time(t.flights, t.carriers),
    "x8_delay_causes": lambda t: explore.delay_causes(t.flights),
    "x9_busiest_routes": lambda t: explore.busiest_routes(t.flights),
    "x10_weekend_vs_weekday": lambda t: explore.weekend_vs_weekday(t.flights),
    "x11_worst_routes": lambda t: explore.worst_routes(t.flights, ROUTE_MIN_FLIGHTS),
    "x12_primary_cause_distribution": lambda t: explore.primary_cause_distribution(t.flights),
    # Advanced
    "a1_top_carriers": lambda t: advanced.top_carriers(t.flights, t.carriers),
    "a2_month_over_month": lambda t: advanced.month_over_month(t.flights),
    "a3_airport_congestion": lambda t: advanced.airport_congestion(t.flights, t.airports),
    "a4_delay_cascade": lambda t: advanced.delay_cascade(t.flights, t.carriers),
    "a5_route_decomposition": lambda t: advanced.route_decomposition(t.flights),
    "a6_hub_efficiency": lambda t: advanced.hub_efficiency(t.flights, t.airports, HUBS),
    "a7_heatmap_long": lambda t: advanced.heatmap_long(t.flights),
    "a7_heatmap_wide": lambda t: advanced.heatmap_wide(t.flights),
    "a8_market_share_vs_delay": lambda t: advanced.market_share_vs_delay(t.flights, t.carriers),
    "a9_cancellations_by_season": lambda t: advanced.cancellations_by_season(
        t.flights, t.calendar
    ),
    "a10_rolling_delay": lambda t: advanced.rolling_delay(t.flights),
    "a11_year_over_year": lambda t: advanced.year_over_year(t.flights),
    "a12_route_severity": lambda t: advanced.route_severity(
        t.flights, t.airports, min_flights=SEVERITY_MIN_FLIGHTS
    ),
    "a13_connections": lambda t: connections(t.flights, origin=None, date=None),
    "a14_severity_distribution": lambda t: advanced.severity_distribution(t.flights),
    "a15_carrier_momentum": lambda t: advanced.carrier_momentum(t.flights, t.carriers),
    # Dashboard
    "r1_overview": lambda t: service.overview(t.flights),
    "r2_delays_by_hour": lambda t: service.delays_by_hour(t.flights),
    "r3_delays_by_carrier": lambda t: service.delays_by_carrier(t.flights, t.carriers),
    "r4_delays_by_airport": lambda t: service.delays_by_airport(t.flights, t.airports),
    "r5_delay_causes": lambda t: service.delay_causes(t.flights),
    "r6_monthly_trends": lambda t: service.monthly_trends(t.flights),
    "r7_day_of_week_patterns": lambda t: service.day_of_week_patterns(t.flights),
    "r8_delay_heatmap": lambda t: service.delay_heatmap(t.flights),
    "r9_worst_routes": lambda t: service.top_routes(
        t.flights, "worst", min_flights=ROUTE_MIN_FLIGHTS
    ),
    "r9_best_routes": lambda t: service.top_routes(
        t.flights, "best", min_flights=ROUTE_MIN_FLIGHTS
    ),
    "r10_cancellations": lambda t: service.cancellations(t.flights),
    "r11_carrier_ranking": lambda t: service.carrier_ranking(t.flights, t.carriers),
    # Export datasets
    "d1_overview": _dataset("overview"),
    "d2_carriers": _dataset("carriers"),
    "d3_airports": _dataset("airports"),
    "d4_hourly": _dataset("hourly"),
    "d5_causes": _dataset("causes"),
    "d6_trends": _dataset("trends"),
    "d7_cancellations": _dataset("cancellations"),
    # Questions
    "n0_classify_questions": classify_questions,
    "n0_classify_composed": classify_composed,
    "n0_classify_documents": classify_documents,
    "n0_classify_conversations": classify_conversations,
    "n1_best_airline": _intent("best_airline"),
    "n2_worst_airline": _intent("worst_airline"),
    "n3_airline_ranking": _intent("airline_ranking"),
    "n4_peak_delay_hours": _intent("peak_delay_hours"),
    "n5_delay_causes": _intent("delay_causes"),
    "n6_weather_delays": _intent("weather_delays"),
    "n7_airport_comparison": _intent("airport_comparison"),
    "n8_busiest_airport": _intent("busiest_airport"),
    "n9_cancellation_info": _intent("cancellation_info"),
    "n10_monthly_trends": _intent("monthly_trends"),
    "n11_seasonal": _intent("seasonal"),
    "n12_route_analysis": lambda t: questions.route_analysis(
        t.flights, t.carriers, t.airports, t.calendar, ROUTE_MIN_FLIGHTS
    ),
    "n13_general_stats": _intent("general_stats"),
    "n14_insights": lambda t: questions.insights(
        t.flights, t.carriers, route_min_flights=ROUTE_MIN_FLIGHTS
    ),
    "n15_answer_questions": lambda t: questions.answer_questions(
        asked(t), t.flights, t.carriers, route_min_flights=ROUTE_MIN_FLIGHTS
    ),
    "n15_answer_rows": lambda t: questions.answer_rows(
        t.flights, t.carriers, t.airports, t.calendar, ROUTE_MIN_FLIGHTS
    ),
    "n16_sample_questions": sample_question_use,
    # Chart data
    "p1_delay_histogram": lambda t: charts.delay_histogram(t.flights),
    "p2_delay_stats": lambda t: charts.delay_stats(t.flights),
    "p3_delay_box": lambda t: charts.delay_box(t.flights),
    "p4_correlation_matrix": lambda t: charts.correlation_matrix(t.flights),
    "p5_missing_values": lambda t: charts.missing_values(t.flights),
    "p6_daily_volume": lambda t: charts.daily_volume(t.flights),
    "p6_peak_day": lambda t: charts.peak_day(t.flights),
    "p7_carrier_delay_rates": lambda t: charts.carrier_delay_rates(t.flights),
    "p8_dep_arr_sample": lambda t: charts.departure_arrival_sample(t.flights),
    "p8_axis_limit": lambda t: charts.axis_limit(t.flights),
    "p9_dep_arr_correlation": lambda t: charts.departure_arrival_correlation(t.flights),
    "p10_dataset_overview": lambda t: charts.dataset_overview(t.flights),
    "p11_hourly_profile": lambda t: charts.hourly_profile(t.flights),
    "p11_peak_hour": lambda t: charts.peak_hour(t.flights),
    "p12_cause_shares": lambda t: charts.cause_shares(t.flights),
    "p13_carrier_cause_means": lambda t: charts.carrier_cause_means(t.flights),
    "p14_carrier_delay_boxes": lambda t: charts.carrier_delay_boxes(t.flights),
    "p15_delayed_median": lambda t: charts.delayed_median(t.flights),
    "p16_severity_breakdown": lambda t: charts.severity_breakdown(t.flights),
    "p16_severe_total": lambda t: charts.severe_total(t.flights),
    "p17_monthly_profile": lambda t: charts.monthly_profile(t.flights),
    "p18_weekend_profile": lambda t: charts.weekend_profile(t.flights),
    "p19_day_of_week_profile": lambda t: charts.day_of_week_profile(t.flights),
    "p20_busiest_airports": lambda t: charts.busiest_airports(t.flights),
    "p21_most_delayed_airports": lambda t: charts.most_delayed_airports(
        t.flights, AIRPORT_MIN_FLIGHTS
    ),
    "p22_airport_quadrants": lambda t: charts.airport_quadrants(t.flights),
    "p23_hub_comparison": lambda t: charts.hub_comparison(t.flights, NAMED_HUBS),
    "p24_geographic_delay": lambda t: charts.geographic_delay(t.flights, t.airports),
    "p25_monthly_trend": lambda t: charts.monthly_trend(t.flights),
    "p26_day_of_week_pattern": lambda t: charts.day_of_week_pattern(t.flights),
    "p27_day_hour_matrix": lambda t: charts.day_hour_matrix(t.flights),
    "p28_weekly_trend": lambda t: charts.weekly_trend(t.flights),
    "p29_holiday_periods": lambda t: charts.holiday_periods(t.flights, WINDOWS),
    # Report tables
    "e1_summary": lambda t: reports.summary(t.flights),
    "e2_hourly": lambda t: reports.hourly(t.flights),
    "e3_carrier_performance": lambda t: reports.carrier_performance(t.flights, t.carriers),
    "e4_airport_performance": lambda t: reports.airport_performance(t.flights, t.airports),
    "e5_monthly": lambda t: reports.monthly(t.flights),
    "e6_delay_causes": lambda t: reports.delay_causes(t.flights),
    # Model
    "m2_m5_features": features,
    "m6_split_counts": split_counts,
    "m6_split_by_carrier": split_by_carrier,
    "m7_fitted_forest": fitted_forest,
    "m8_base_metrics": lambda t: _rounded(
        delay_model.metrics(_base_scored(t)), "accuracy", "precision", "recall", "f1", "roc_auc"
    ),
    "m8_base_class_report": lambda t: _rounded(
        delay_model.class_report(_base_scored(t)), "precision", "recall", "f1"
    ),
    "m10_base_roc_curve": lambda t: _rounded(
        delay_model.roc_curve(_base_scored(t)),
        "threshold",
        "false_positive_rate",
        "true_positive_rate",
    ),
    "m11_base_confusion_matrix": lambda t: _rounded(
        delay_model.confusion_matrix(_base_scored(t)), "pct"
    ),
    "m12_base_permutation_importance": base_permutation,
    "m7_node_table": lambda t: _rounded(delay_model.node_table(t.spark, _forest(t)), "gain"),
    "m8_metrics": lambda t: _rounded(
        delay_model.metrics(_scored(t)), "accuracy", "precision", "recall", "f1", "roc_auc"
    ),
    "m8_class_report": lambda t: _rounded(
        delay_model.class_report(_scored(t)), "precision", "recall", "f1"
    ),
    "m8_scores_by_carrier": scores_by_carrier,
    "m9_feature_importance": lambda t: _rounded(
        delay_model.tree_importance(t.spark, _forest(t)), "importance"
    ),
    "m10_roc_curve": lambda t: _rounded(
        delay_model.roc_curve(_scored(t)),
        "threshold",
        "false_positive_rate",
        "true_positive_rate",
    ),
    "m11_confusion_matrix": lambda t: _rounded(
        delay_model.confusion_matrix(_scored(t)), "pct"
    ),
    "m12_permutation_importance": permutation_importance,
    "m12_attribution_summary": lambda t: _rounded(
        delay_model.attribution_summary(_sides(t)[1], _forest(t)), "mean_size", "mean"
    ),
    "m13_saved_metrics": saved_metrics,
    # BI measures and chart reshapes
    "b1_b4_measures_by_carrier": lambda t: bi.bi_measures(t.flights, "carrier_code"),
    "b1_b4_measures_overall": lambda t: bi.bi_measures(t.flights),
    "b5_yoy_delay_change": lambda t: bi.yoy_delay_change(t.flights),
    "f1_carriers_by_delay": lambda t: bi.carriers_by_delay(
        service.carrier_ranking(t.flights, t.carriers)
    ),
    "f2_normalised_heatmap": lambda t: bi.normalised_heatmap(service.delay_heatmap(t.flights)),
    "f3_month_labels": lambda t: bi.month_labels(service.monthly_trends(t.flights)),
}
