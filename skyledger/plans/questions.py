"""Answer plain-language questions about flights, a table of questions at a time."""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.functions import measures as m
from skyledger.functions.fixed_values import (
    CAUSE_LABELS,
    FALLBACK_INTENT,
    INTENT_CHARTS,
    INTENT_OPENINGS,
    INTENT_PATTERNS,
    NO_DATA,
    SAMPLE_QUESTIONS,
)
from skyledger.functions.numeric import asc, desc, pct, ratio, round_to
from skyledger.operators.longform import rows_from_columns
from skyledger.operators.lookup import with_airport, with_carrier
from skyledger.operators.scoring import position_by
from skyledger.operators.topk import top_k
from skyledger.plans import service


def with_intent(questions: DataFrame, text: str) -> DataFrame:
    """Add ``intent``: the first one, in registry order, with a pattern found in the text.

    Texts are lower-cased once, in a projection of their own.
    """
    lowered = questions.withColumn("lowered", F.lower(F.trim(text)))
    intents = [
        F.when(reduce(Column.__or__, [_found(p) for p in patterns]), F.lit(intent))
        for intent, patterns in INTENT_PATTERNS.items()
    ]
    return lowered.withColumn("intent", F.coalesce(*intents, F.lit(FALLBACK_INTENT))).drop(
        "lowered"
    )


def _found(pattern: str) -> Column:
    """Whether a pattern occurs in ``lowered``.

    Plain substring tests for the fixed words of the pattern come first, and
    decide alone if it is nothing but a word, so that few long texts reach the
    regular expression.  ``(?d)`` ends ``.`` at newlines only and ``(?U)`` makes
    word boundaries respect accented letters.
    """
    words = re.split(r"\\b|\.\*|\.\?", pattern)
    tests = [F.contains(F.col("lowered"), F.lit(word)) for word in words if word]
    if words != [pattern]:
        tests.append(F.col("lowered").rlike("(?dU)" + pattern))
    return reduce(Column.__and__, tests)


def sample_questions(spark: SparkSession) -> DataFrame:
    return spark.range(len(SAMPLE_QUESTIONS)).select(
        F.col("id").alias("question_id"),
        F.element_at(
            F.array(*map(F.lit, SAMPLE_QUESTIONS)), F.col("id").cast("int") + 1
        ).alias("question"),
    )


# The rows behind each intent.


def _carrier_rows(flights, carriers, *columns: str) -> DataFrame:
    rates = service.carrier_rates(flights, carriers).withColumnRenamed("delay_pct", "delay_rate")
    return rates.select("carrier_code", "carrier_name", "total_flights", *columns, "avg_delay")


def best_airline(flights, carriers, airports, calendar) -> DataFrame:
    rows = _carrier_rows(flights, carriers, "on_time_pct")
    return top_k(rows, [*desc("on_time_pct"), *asc("carrier_code")])


def worst_airline(flights, carriers, airports, calendar) -> DataFrame:
    rows = _carrier_rows(flights, carriers, "delay_rate")
    return top_k(rows, [*desc("delay_rate"), *asc("carrier_code")])


def airline_ranking(flights, carriers, airports, calendar) -> DataFrame:
    rows = _carrier_rows(flights, carriers, "on_time_pct", "delay_rate")
    return top_k(rows, [*desc("on_time_pct"), *asc("carrier_code")])


def peak_delay_hours(flights, carriers, airports, calendar) -> DataFrame:
    return service.delays_by_hour(flights)


def delay_causes(flights, carriers, airports, calendar) -> DataFrame:
    return service.delay_causes(flights)


def _by_season(flights: DataFrame, calendar: DataFrame, **sums: Column) -> DataFrame:
    """Sums per day first, so the calendar joins one row per day."""
    daily = (
        flights.filter(F.col("cancelled") == 0)
        .groupBy("flight_date")
        .agg(m.flights().alias("n"), *[agg.alias(name) for name, agg in sums.items()])
    )
    return (
        daily.join(calendar.select("flight_date", "season"), "flight_date")
        .groupBy("season")
        .agg(F.sum("n").alias("total_flights"), *[F.sum(name).alias(name) for name in sums])
    )


def weather_delays(flights, carriers, airports, calendar) -> DataFrame:
    seasons = _by_season(
        flights,
        calendar,
        minutes=F.sum("weather_delay"),
        known=F.count("weather_delay"),
        hit=F.count_if(F.col("weather_delay") > 0),
    )
    rows = seasons.select(
        "season",
        round_to(ratio(F.col("minutes"), F.col("known")), 2).alias("avg_weather_delay"),
        F.col("hit").alias("weather_delayed_flights"),
        "total_flights",
    )
    return top_k(rows, [*desc("avg_weather_delay"), *asc("season")])


def airport_comparison(flights, carriers, airports, calendar) -> DataFrame:
    return service.delays_by_airport(flights, airports, 20)


def busiest_airport(flights, carriers, airports, calendar) -> DataFrame:
    by_origin = flights.groupBy(F.col("origin").alias("airport_code")).agg(
        m.flights().alias("total_flights")
    )
    named = with_airport(by_origin, airports, "airport_name", code="airport_code").select(
        "airport_code",
        F.coalesce("airport_name", "airport_code").alias("airport_name"),
        "total_flights",
    )
    return top_k(named, [*desc("total_flights"), *asc("airport_code")], 20)


def cancellation_info(flights, carriers, airports, calendar) -> DataFrame:
    rows = service.cancellation_counts(flights)
    return top_k(rows, [*desc("count"), *asc("cancellation_code")])


def monthly_trends(flights, carriers, airports, calendar) -> DataFrame:
    return service.monthly_trends(flights)


def seasonal(flights, carriers, airports, calendar) -> DataFrame:
    late = F.col("arr_delay_minutes") > 0
    seasons = _by_season(
        flights,
        calendar,
        delayed=F.sum("is_delayed"),
        minutes=F.sum(F.when(late, F.col("arr_delay_minutes"))),
        late=F.count_if(late),
    )
    rows = seasons.select(
        "season",
        pct(F.col("delayed"), F.col("total_flights")).alias("delay_rate"),
        round_to(ratio(F.col("minutes"), F.col("late")), 2).alias("avg_delay"),
        "total_flights",
    )
    return top_k(rows, [*desc("delay_rate"), *asc("season")])


def route_analysis(flights, carriers, airports, calendar, min_flights: int = 500) -> DataFrame:
    return service.top_routes(flights, "worst", 20, min_flights)


def general_stats(flights, carriers, airports, calendar) -> DataFrame:
    return service.overview(flights)


INTENT_ROWS: dict[str, Callable[..., DataFrame]] = {
    "best_airline": best_airline,
    "worst_airline": worst_airline,
    "airline_ranking": airline_ranking,
    "peak_delay_hours": peak_delay_hours,
    "delay_causes": delay_causes,
    "weather_delays": weather_delays,
    "airport_comparison": airport_comparison,
    "busiest_airport": busiest_airport,
    "cancellation_info": cancellation_info,
    "monthly_trends": monthly_trends,
    "seasonal": seasonal,
    "route_analysis": route_analysis,
    "general_stats": general_stats,
}


def answer_rows(
    flights: DataFrame,
    carriers: DataFrame,
    airports: DataFrame,
    calendar: DataFrame,
    route_min_flights: int = 500,
) -> DataFrame:
    """The rows behind every answer: (intent, position, row), a row as JSON text.

    Numbers are written with two decimals. The results are short lists of aggregates.
    """
    found = []
    for intent, rows_of in INTENT_ROWS.items():
        extra = {"min_flights": route_min_flights} if intent == "route_analysis" else {}
        rows = rows_of(flights, carriers, airports, calendar, **extra)
        fields = [
            F.col(c) if kind == "string" else F.col(c).cast("decimal(20, 2)").cast("string").alias(c)
            for c, kind in rows.dtypes
        ]
        row = F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})
        found.append(
            rows.select(row.alias("row"), F.monotonically_increasing_id().alias("place")).select(
                F.lit(intent).alias("intent"), position_by("place").alias("position"), "row"
            )
        )
    return reduce(DataFrame.union, found)


# One sentence per intent.


def insights(
    flights: DataFrame,
    carriers: DataFrame,
    airport_min_flights: int = 1000,
    route_min_flights: int = 500,
) -> DataFrame:
    """One (intent, insight) row per intent, from a single scan of the flights.

    The thresholds are those of the rows behind the airport and route answers.

    Grouping sets give the figures per carrier, hour, origin and route and over
    everything; the leading row of each is then picked by an ordered minimum.
    Intents whose rows need no comment have an empty insight.
    """
    completed = F.col("cancelled") == 0
    sets = ["carrier_code", "hour_of_day", "origin", "route"]
    cells = flights.groupingSets([[c] for c in sets] + [[]], *sets).agg(
        F.grouping_id().alias("grain"),
        m.flights().alias("n"),
        F.count_if(completed).alias("completed"),
        m.on_time_api().alias("on_time_pct"),
        m.delay_rate_flag().alias("delay_pct"),
        m.cancel_rate_by_count().alias("cancel_pct"),
        pct(F.count_if((F.col("is_delayed") == 1) & completed), F.count_if(completed)).alias(
            "completed_delay_pct"
        ),
        *[F.coalesce(F.sum(F.when(F.col("is_delayed") == 1, F.col(c))), F.lit(0.0)).alias(c)
          for c in CAUSE_LABELS],
    )
    everything = (1 << len(sets)) - 1
    grain = {
        name: F.col("grain") == everything - (1 << place)
        for place, name in enumerate(reversed(sets))
    }
    named = with_carrier(cells, carriers)
    airline = grain["carrier_code"] & F.col("carrier_name").isNotNull()
    overall = F.col("grain") == everything
    hour = grain["hour_of_day"] & (F.col("completed") > 0)

    def leader(condition: Column, measure: str, tie: str) -> Column:
        row = F.struct("carrier_name", "hour_of_day", "n", "on_time_pct", "delay_pct",
                       "completed_delay_pct")
        order = F.struct(-F.col(measure), tie)
        return F.min_by(F.when(condition, row), F.when(condition, order))

    facts = named.agg(
        leader(airline, "on_time_pct", "carrier_code").alias("best"),
        leader(airline, "delay_pct", "carrier_code").alias("worst"),
        leader(hour, "completed_delay_pct", "hour_of_day").alias("hour"),
        F.max(F.when(overall, F.struct("n", "completed", "on_time_pct", "delay_pct",
                                       "cancel_pct", *CAUSE_LABELS))).alias("all"),
        F.max(F.when(grain["origin"], F.col("completed"))).alias("origin_max"),
        F.max(F.when(grain["route"], F.col("completed"))).alias("route_max"),
    )

    best = F.concat(
        F.col("best.carrier_name"), F.lit(" leads with "), _text("best.on_time_pct"),
        F.lit("% on-time performance across "), _grouped("best.n"), F.lit(" flights."),
    )
    has_completed = F.coalesce(F.col("all.completed"), F.lit(0)) > 0
    cancelled = F.coalesce(F.col("all.n") - F.col("all.completed"), F.lit(0)) > 0
    sentences = {
        "best_airline": best,
        "worst_airline": F.concat(
            F.col("worst.carrier_name"), F.lit(" has the highest delay rate at "),
            _text("worst.delay_pct"), F.lit("%."),
        ),
        "airline_ranking": best,
        "peak_delay_hours": F.concat(
            F.lit("Hour "), _text("hour.hour_of_day"), F.lit(":00 has the highest delay rate at "),
            _text("hour.completed_delay_pct"), F.lit("%."),
        ),
        "delay_causes": _leading_cause(),
        "weather_delays": F.when(has_completed, ""),
        "airport_comparison": F.when(F.col("origin_max") >= airport_min_flights, ""),
        "busiest_airport": F.when(F.col("all.n") > 0, ""),
        "cancellation_info": F.when(cancelled, ""),
        "monthly_trends": F.when(has_completed, ""),
        "seasonal": F.when(has_completed, ""),
        "route_analysis": F.when(F.col("route_max") >= route_min_flights, ""),
        "general_stats": F.concat(
            F.lit("The dataset contains "), _grouped("all.n"), F.lit(" flights. On-time: "),
            _text("all.on_time_pct"), F.lit("%, Delayed: "), _text("all.delay_pct"),
            F.lit("%, Cancelled: "), _text("all.cancel_pct"), F.lit("%."),
        ),
    }
    return rows_from_columns(
        facts,
        [
            {"intent": F.lit(intent), "insight": F.coalesce(sentence, F.lit(NO_DATA))}
            for intent, sentence in sentences.items()
        ],
    )


def _leading_cause() -> Column:
    minutes = {label: F.col(f"all.{c}") for c, label in CAUSE_LABELS.items()}
    total = sum(minutes.values(), F.lit(0.0))
    top = F.greatest(*minutes.values())
    in_name_order = sorted(minutes)
    name = F.coalesce(*[F.when(minutes[label] == top, F.lit(label)) for label in in_name_order])
    return F.concat(
        F.lit("'"), name, F.lit("' is the leading delay cause, accounting for "),
        F.coalesce(pct(top, total).cast("string"), F.lit("None")),
        F.lit("% of total delay minutes."),
    )


def _text(column: str) -> Column:
    return F.col(column).cast("string")


def _grouped(column: str) -> Column:
    """A whole number with thousands separators."""
    return F.format_number(F.col(column), 0)


def answers(flights: DataFrame, carriers: DataFrame, **thresholds: int) -> DataFrame:
    """One row per intent: the full answer text and the chart that suits it."""
    opening = F.create_map(*[F.lit(x) for kv in INTENT_OPENINGS.items() for x in kv])
    chart = F.create_map(*[F.lit(x) for kv in INTENT_CHARTS.items() for x in kv])
    comment = F.when(F.col("insight") == "", "").otherwise(F.concat(F.lit("\n\n"), "insight"))
    return insights(flights, carriers, **thresholds).select(
        "intent",
        F.concat(opening[F.col("intent")], comment).alias("answer"),
        chart[F.col("intent")].alias("chart_type"),
    )


def answer_questions(
    questions: DataFrame,
    flights: DataFrame,
    carriers: DataFrame,
    text: str = "question",
    **thresholds: int,
) -> DataFrame:
    """Every question with its intent, answer and chart type.

    The answers are one row per intent, thirteen in all, so that side is
    broadcast and the questions are neither shuffled nor collected.  The rows
    behind an answer come from ``INTENT_ROWS``.
    """
    classified = with_intent(questions, text)
    return classified.join(F.broadcast(answers(flights, carriers, **thresholds)), "intent")
