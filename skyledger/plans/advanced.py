"""Rankings, trends, composite scores, heatmaps and distributions over flights."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyledger.functions import measures as m
from skyledger.functions.fixed_values import (
    CANCELLATION_REASONS_SEASON,
    CAUSE_LABELS,
    CONGESTION_TIERS,
    CONGESTION_WEIGHTS,
    DAY_ABBREVIATIONS,
    DELAY_BUCKETS,
    SEVERITY_WEIGHTS,
)
from skyledger.functions.labels import bucket_of, label_of
from skyledger.functions.numeric import (
    asc,
    desc,
    in_units,
    pct,
    ratio,
    round_to,
    rounded_mean,
)
from skyledger.operators.lookup import with_airport, with_carrier
from skyledger.operators.quantiles import WEIGHT, count_values, quantile, weighted_mean
from skyledger.operators.scoring import (
    composite_score,
    dense_rank_by,
    over_all,
    percentile_rank,
    position_by,
    rank_by,
    share_of_total,
    tile_by,
)
from skyledger.operators.topk import top_k


def _share(part: Column, total: Column, digits: int = 2) -> Column:
    """``100 * (part / total)``, dividing first."""
    return round_to(F.lit(100.0) * ratio(part, total), digits)


def top_carriers(
    flights: DataFrame, carriers: DataFrame, min_flights: int = 1000, limit: int = 5
) -> DataFrame:
    """Carriers by known on-time arrivals, with three ways of numbering ties."""
    counted = count_values(
        flights.filter(F.col("cancelled") == 0),
        ["carrier_code"],
        "arr_delay",
        on_time=F.count_if(F.col("arr_del15") == 0),
    )
    by_carrier = (
        counted.groupBy("carrier_code")
        .agg(
            F.sum(WEIGHT).alias("total_flights"),
            pct(F.sum("on_time"), F.sum(WEIGHT)).alias("on_time_pct"),
            round_to(weighted_mean("arr_delay"), 2).alias("avg_arr_delay_min"),
            round_to(quantile("arr_delay", 0.5), 1).alias("median_arr_delay"),
            round_to(quantile("arr_delay", 0.95), 1).alias("p95_arr_delay"),
        )
        .filter(F.col("total_flights") >= min_flights)
    )
    ranked = with_carrier(by_carrier, carriers).select(
        "carrier_code",
        "carrier_name",
        "total_flights",
        "on_time_pct",
        "avg_arr_delay_min",
        "median_arr_delay",
        "p95_arr_delay",
        rank_by(*desc("on_time_pct")).alias("rank_on_time"),
        dense_rank_by(*desc("on_time_pct")).alias("dense_rank_on_time"),
        position_by(*desc("on_time_pct", "total_flights"), *asc("carrier_code")).alias("row_num"),
    )
    return top_k(ranked, asc("row_num"), limit)


def month_over_month(flights: DataFrame) -> DataFrame:
    monthly = flights.groupBy("year", "month").agg(
        m.flights().alias("flights"),
        m.delay_rate_arr15().alias("delay_rate_pct"),
        m.mean("arr_delay", 2).alias("avg_arr_delay"),
        m.cancel_rate().alias("cancel_rate_pct"),
    )
    in_time = over_all("year", "month")
    rate = F.col("delay_rate_pct")
    previous = F.lag("delay_rate_pct").over(in_time)
    return monthly.select(
        "year",
        "month",
        "flights",
        "delay_rate_pct",
        previous.alias("prev_month_delay_rate"),
        F.lead("delay_rate_pct").over(in_time).alias("next_month_delay_rate"),
        round_to(rate - previous, 2).alias("mom_change_pp"),
        round_to(F.try_divide(F.lit(100.0) * (rate - previous), previous), 2).alias(
            "mom_change_pct"
        ),
        "avg_arr_delay",
        F.lag("avg_arr_delay").over(in_time).alias("prev_avg_arr_delay"),
        "cancel_rate_pct",
        F.lag("cancel_rate_pct").over(in_time).alias("prev_cancel_rate"),
    ).orderBy("year", "month")


def airport_congestion(
    flights: DataFrame,
    airports: DataFrame,
    weights: dict[str, float] = CONGESTION_WEIGHTS,
    min_flights: int = 500,
) -> DataFrame:
    """Origins scored by weighted percentile ranks and split into five tiers."""
    counted = count_values(
        flights.withColumnRenamed("origin", "airport"),
        ["airport"],
        "dep_delay",
        late=F.count_if(F.col("dep_del15") == 1),
        cancelled=m.cancelled_count(),
    )
    total = F.sum(WEIGHT)
    by_airport = (
        counted.groupBy("airport")
        .agg(
            total.alias("departures"),
            _share(F.sum("late"), total).alias("dep_delay_rate_pct"),
            round_to(weighted_mean("dep_delay"), 2).alias("avg_dep_delay"),
            round_to(quantile("dep_delay", 0.9), 1).alias("p90_dep_delay"),
            _share(F.sum("cancelled"), total).alias("cancel_rate_pct"),
        )
        .filter(F.col("departures") >= min_flights)
    )
    scored = composite_score(by_airport, weights, "congestion_score", 4).withColumns(
        {
            "delay_quintile": tile_by(5, *asc("dep_delay_rate_pct", "airport")),
            "delay_percentile_rank": round_to(percentile_rank("dep_delay_rate_pct"), 4),
        }
    )
    return (
        with_airport(scored, airports, "airport_name", "city")
        .select(
            "airport",
            "airport_name",
            "city",
            "departures",
            "dep_delay_rate_pct",
            "avg_dep_delay",
            "p90_dep_delay",
            "cancel_rate_pct",
            "congestion_score",
            "delay_quintile",
            label_of("delay_quintile", CONGESTION_TIERS).alias("congestion_tier"),
            "delay_percentile_rank",
        )
        .orderBy(*desc("congestion_score"), *asc("airport"))
    )


def delay_cascade(flights: DataFrame, carriers: DataFrame) -> DataFrame:
    """How a late incoming aircraft carries over to the arrival, by carrier."""
    affected = flights.filter(
        (F.col("cancelled") == 0)
        & (F.col("late_aircraft_delay") > 0)
        & F.col("dep_delay").isNotNull()
        & F.col("arr_delay").isNotNull()
    ).select(
        "carrier_code",
        "late_aircraft_delay",
        "dep_delay",
        "arr_delay",
        (F.col("arr_delay") - F.col("dep_delay")).alias("in_air"),
        in_units(pct(F.col("late_aircraft_delay"), F.col("arr_delay_minutes"), 1), 1).alias(
            "tenths"
        ),
    )
    by_carrier = affected.groupBy("carrier_code").agg(
        m.flights().alias("affected_flights"),
        m.mean("late_aircraft_delay", 1).alias("avg_late_aircraft_min"),
        m.mean("dep_delay", 1).alias("avg_dep_delay"),
        m.mean("arr_delay", 1).alias("avg_arr_delay"),
        m.mean("in_air", 1).alias("avg_in_air_delta"),
        rounded_mean(F.sum("tenths"), F.count("tenths"), 1).alias("avg_late_aircraft_pct"),
        F.count_if(F.col("in_air") > 0).alias("worsened_count"),
        F.count_if(F.col("in_air") < 0).alias("recovered_count"),
        round_to(F.corr("late_aircraft_delay", "arr_delay"), 4).alias("corr_late_aircraft_arr"),
    )
    return (
        with_carrier(by_carrier, carriers)
        .select(
            "carrier_code",
            "carrier_name",
            "affected_flights",
            "avg_late_aircraft_min",
            "avg_dep_delay",
            "avg_arr_delay",
            "avg_in_air_delta",
            "avg_late_aircraft_pct",
            "worsened_count",
            "recovered_count",
            pct(F.col("worsened_count"), F.col("affected_flights"), 1).alias("pct_worsened"),
            "corr_late_aircraft_arr",
            rank_by(*desc("avg_in_air_delta")).alias("cascade_severity_rank"),
        )
        .orderBy("cascade_severity_rank", "carrier_code")
    )


def route_decomposition(flights: DataFrame, top_n: int = 50) -> DataFrame:
    """Delay minutes by cause on the busiest routes.

    Totals cover every flight that was not cancelled.  Security counts towards
    the shares but cannot be the dominant cause.  One aggregate serves both the
    choice of routes and their figures.
    """
    by_route = (
        flights.filter(F.col("cancelled") == 0)
        .groupBy("route", "origin", "dest")
        .agg(
            m.flights().alias("total_flights"),
            m.delayed_count().alias("delayed_flights"),
            m.delay_rate_arr15().alias("delay_rate_pct"),
            *[m.mean(c, 2).alias(f"avg_{c}") for c in CAUSE_LABELS],
            *[F.sum(c).alias(f"total_{c}") for c in CAUSE_LABELS],
        )
    )
    busiest = top_k(by_route, [*desc("total_flights"), *asc("route")], top_n)
    total = {c: F.col(f"total_{c}") for c in CAUSE_LABELS}
    everything = reduce(Column.__add__, total.values())
    contenders = [c for c in CAUSE_LABELS if c != "security_delay"]

    def leads(cause: str) -> Column:
        return total[cause] >= F.greatest(*[total[c] for c in contenders if c != cause])

    dominant = F.coalesce(
        *[F.when(leads(c), F.lit(CAUSE_LABELS[c])) for c in contenders[:-1]],
        F.lit(CAUSE_LABELS[contenders[-1]]),
    )
    return busiest.select(
        "route",
        "origin",
        "dest",
        "total_flights",
        "delayed_flights",
        "delay_rate_pct",
        *[f"avg_{c}" for c in contenders],
        *[
            pct(total[c], everything, 1).alias(f"pct_{c.removesuffix('_delay')}")
            for c in contenders
        ],
        dominant.alias("dominant_cause"),
    ).orderBy(*desc("delay_rate_pct"), *asc("route"))


def hub_efficiency(flights: DataFrame, airports: DataFrame, n_hubs: int = 30) -> DataFrame:
    """The largest origins, ranked; every origin as large as the ``n_hubs``-th is a hub.

    Delay values, destinations and carriers per origin are counted as three
    grouping sets of one scan, each combined before the shuffle.
    """
    cells = flights.groupingSets(
        [["origin", "dep_delay"], ["origin", "dest"], ["origin", "carrier_code"]],
        "origin",
        "dep_delay",
        "dest",
        "carrier_code",
    ).agg(
        (F.grouping("dep_delay") == 0).alias("is_value"),
        F.count(F.lit(1)).alias(WEIGHT),
        m.delayed_count().alias("late"),
        m.cancelled_count().alias("cancelled"),
        F.sum("arr_delay").alias("arr_sum"),
        F.count("arr_delay").alias("arr_count"),
        F.sum("distance").alias("distance_sum"),
        F.count("distance").alias("distance_count"),
    )

    def total(column: str) -> Column:
        return F.sum(F.when(F.col("is_value"), F.col(column)))

    value = F.when(F.col("is_value"), F.col("dep_delay"))
    known = F.when(value.isNotNull(), F.col(WEIGHT))
    by_origin = cells.groupBy(F.col("origin").alias("airport")).agg(
        total(WEIGHT).alias("departures"),
        _share(total("late"), total(WEIGHT)).alias("delay_rate_pct"),
        round_to(ratio(total("arr_sum"), total("arr_count")), 2).alias("avg_arr_delay"),
        round_to(ratio(F.sum(value * F.col(WEIGHT)), F.sum(known)), 2).alias("avg_dep_delay"),
        round_to(quantile(value, 0.95), 1).alias("p95_dep_delay"),
        _share(total("cancelled"), total(WEIGHT)).alias("cancel_rate_pct"),
        F.count("dest").alias("destinations_served"),
        F.count("carrier_code").alias("carriers_operating"),
        round_to(ratio(total("distance_sum"), total("distance_count")), 0).alias(
            "avg_route_distance"
        ),
    )
    by_volume = F.row_number().over(over_all(*desc("departures")))
    hubs = (
        by_origin.withColumn("place", by_volume)
        .withColumn(
            "cutoff",
            F.min(F.when(F.col("place") <= n_hubs, F.col("departures"))).over(over_all()),
        )
        .filter(F.col("departures") >= F.col("cutoff"))
        .drop("place", "cutoff")
    )
    return (
        with_airport(hubs, airports, "airport_name", "city")
        .select(
            "airport",
            "airport_name",
            "city",
            *[c for c in hubs.columns if c != "airport"],
            rank_by(*asc("delay_rate_pct")).alias("efficiency_rank"),
            dense_rank_by(*desc("departures")).alias("volume_rank"),
            tile_by(3, *asc("delay_rate_pct", "airport")).alias("efficiency_tier"),
        )
        .orderBy("efficiency_rank", "airport")
    )


def _heatmap_scope(flights: DataFrame) -> DataFrame:
    return flights.filter((F.col("cancelled") == 0) & F.col("hour_of_day").isNotNull())


def heatmap_long(flights: DataFrame) -> DataFrame:
    cells = (
        _heatmap_scope(flights)
        .groupBy("hour_of_day", "day_of_week")
        .agg(
            m.flights().alias("flights"),
            m.delay_rate_arr15().alias("delay_rate_pct"),
            m.mean("arr_delay", 1).alias("avg_arr_delay"),
        )
    )
    return cells.select(
        "hour_of_day",
        "day_of_week",
        label_of("day_of_week", DAY_ABBREVIATIONS).alias("day_name"),
        "flights",
        "delay_rate_pct",
        "avg_arr_delay",
    ).orderBy("hour_of_day", "day_of_week")


def heatmap_wide(flights: DataFrame) -> DataFrame:
    """Late share by hour with one column per weekday; the columns are fixed, not discovered."""
    cells = (
        _heatmap_scope(flights)
        .groupBy("hour_of_day", "day_of_week")
        .agg(m.delay_rate_arr15().alias("delay_rate"))
    )
    named = cells.withColumn("day_name", label_of("day_of_week", DAY_ABBREVIATIONS))
    return (
        named.groupBy("hour_of_day")
        .pivot("day_name", list(DAY_ABBREVIATIONS.values()))
        .agg(F.first("delay_rate"))
        .orderBy("hour_of_day")
    )


def market_share_vs_delay(flights: DataFrame, carriers: DataFrame) -> DataFrame:
    """Size against reliability.

    A positive ``rank_gap`` means more reliable than size predicts, and is
    nevertheless labelled an underperformer; the label is kept as published.
    """
    by_carrier = (
        flights.filter(F.col("cancelled") == 0)
        .groupBy("carrier_code")
        .agg(
            m.flights().alias("total_flights"),
            m.delay_rate_arr15().alias("delay_rate_pct"),
            m.mean("arr_delay", 2).alias("avg_arr_delay"),
            F.countDistinct("route").alias("routes_served"),
            F.countDistinct("origin").alias("airports_served"),
        )
    )
    shared = with_carrier(by_carrier, carriers).withColumn(
        "market_share_pct", share_of_total("total_flights", 4)
    )
    ranked = shared.withColumns(
        {
            "market_rank": rank_by(*desc("market_share_pct")),
            "reliability_rank": rank_by(*asc("delay_rate_pct")),
        }
    ).withColumn("rank_gap", F.col("market_rank") - F.col("reliability_rank"))
    # Labels and their limits.
    label = (
        F.when(F.col("rank_gap") > 2, "Underperformer (big but unreliable)")
        .when(F.col("rank_gap") < -2, "Overperformer (big and reliable)")
        .otherwise("In line with size")
    )
    return ranked.select(
        "carrier_code",
        "carrier_name",
        "total_flights",
        "market_share_pct",
        "delay_rate_pct",
        "avg_arr_delay",
        "routes_served",
        "airports_served",
        "market_rank",
        "reliability_rank",
        "rank_gap",
        label.alias("performance_vs_size"),
    ).orderBy(*desc("market_share_pct"), *asc("carrier_code"))


def cancellations_by_season(flights: DataFrame, calendar: DataFrame) -> DataFrame:
    """Causes of cancellation within each season; days outside the calendar are left out."""
    by_day = (
        flights.filter(F.col("cancelled") == 1)
        .groupBy("flight_date", "cancellation_code")
        .agg(m.flights().alias("n"))
    )
    by_season = (
        by_day.join(calendar.select("flight_date", "season"), "flight_date")
        .groupBy("season", "cancellation_code")
        .agg(F.sum("n").alias("cancellations"))
    )
    season = Window.partitionBy("season")
    return (
        by_season.withColumn("season_total_cancels", F.sum("cancellations").over(season))
        .select(
            "season",
            label_of("cancellation_code", CANCELLATION_REASONS_SEASON, "Unknown").alias(
                "cancel_reason"
            ),
            "cancellation_code",
            "cancellations",
            "season_total_cancels",
            pct(F.col("cancellations"), F.col("season_total_cancels"), 1).alias("pct_of_season"),
            F.rank()
            .over(season.orderBy(*desc("cancellations")))
            .cast("long")
            .alias("cause_rank_in_season"),
        )
        .orderBy(*asc("season", "cause_rank_in_season", "cancellation_code"))
    )


def rolling_delay(flights: DataFrame) -> DataFrame:
    """Daily late share with trailing and centred windows; windows shorten at the ends."""
    daily = (
        flights.filter(F.col("cancelled") == 0)
        .groupBy("flight_date")
        .agg(
            m.flights().alias("flights"),
            m.delay_rate_arr15().alias("delay_rate_pct"),
            m.mean("arr_delay", 2).alias("avg_arr_delay"),
            F.sum("arr_delay_minutes").alias("minutes"),
        )
        .withColumn("units", in_units(F.col("delay_rate_pct"), 2))
    )

    def days(before: int, after: int):
        return over_all("flight_date").rowsBetween(-before, after)

    def smooth(frame) -> Column:
        return rounded_mean(F.sum("units").over(frame), F.count("units").over(frame), 2)

    week = days(6, 0)
    return daily.select(
        "flight_date",
        "flights",
        "delay_rate_pct",
        "avg_arr_delay",
        smooth(week).alias("rolling_7d_delay_rate"),
        smooth(days(3, 3)).alias("centered_7d_delay_rate"),
        smooth(days(13, 0)).alias("rolling_14d_delay_rate"),
        F.sum("minutes").over(week).alias("rolling_7d_total_delay_min"),
        F.min("delay_rate_pct").over(week).alias("rolling_7d_min"),
        F.max("delay_rate_pct").over(week).alias("rolling_7d_max"),
    ).orderBy("flight_date")


def year_over_year(flights: DataFrame) -> DataFrame:
    """Each month against the row 12 months up.

    The lag counts rows, so a missing month shifts the comparison, and without
    a prior row the two differences equal the month's own value.
    ``yoy_delay_change`` in the BI measures compares by calendar instead.
    """
    monthly = flights.groupBy("year", "month").agg(
        m.flights().alias("flights"),
        m.delay_rate_arr15().alias("delay_rate_pct"),
        m.mean("arr_delay", 2).alias("avg_arr_delay"),
    )
    in_time = over_all("year", "month")
    zero = F.lit(0.0)
    compared = monthly.withColumns(
        {
            "py_flights": F.lag(F.col("flights").cast("double"), 12).over(in_time),
            "py_delay_rate_pct": F.lag("delay_rate_pct", 12).over(in_time),
            "py_avg_arr_delay": F.lag("avg_arr_delay", 12).over(in_time),
        }
    )
    rate, before = F.col("delay_rate_pct"), F.col("py_delay_rate_pct")
    # Labels and their limits.
    trend = (
        F.when(before.isNull(), "No prior year")
        .when(rate < before, "Improved")
        .when(rate > before, "Degraded")
        .otherwise("Unchanged")
    )
    return compared.select(
        "year",
        "month",
        "flights",
        "delay_rate_pct",
        "py_flights",
        "py_delay_rate_pct",
        round_to(rate - F.coalesce(before, zero), 2).alias("yoy_delay_change_pp"),
        pct(F.col("flights") - F.coalesce("py_flights", zero), F.col("py_flights")).alias(
            "yoy_flights_change_pct"
        ),
        round_to(F.col("avg_arr_delay") - F.coalesce("py_avg_arr_delay", zero), 2).alias(
            "yoy_avg_delay_change"
        ),
        trend.alias("yoy_trend"),
    ).orderBy("year", "month")


def route_severity(
    flights: DataFrame,
    airports: DataFrame,
    weights: dict[str, float] = SEVERITY_WEIGHTS,
    min_flights: int = 200,
    limit: int | None = 10,
) -> DataFrame:
    """The worst routes by a weighted blend of five percentile ranks."""
    keys = ["route", "origin", "dest"]
    counted = count_values(
        flights,
        keys,
        "arr_delay",
        late=m.delayed_count(),
        cancelled=m.cancelled_count(),
        minutes=F.sum("arr_delay_minutes"),
        minutes_count=F.count("arr_delay_minutes"),
    )
    total = F.sum(WEIGHT)
    x, w = F.col("arr_delay"), F.col(WEIGHT)
    n = F.sum(F.when(x.isNotNull(), w)).cast("double")
    spread = F.sum(x * x * w) - F.try_divide(F.sum(x * w) * F.sum(x * w), n)
    deviation = F.sqrt(F.greatest(F.try_divide(spread, n - 1), F.lit(0.0)))
    by_route = (
        counted.groupBy(*keys)
        .agg(
            total.alias("total_flights"),
            _share(F.sum("late"), total).alias("delay_rate_pct"),
            round_to(ratio(F.sum("minutes"), F.sum("minutes_count")), 2).alias(
                "avg_delay_when_late"
            ),
            round_to(quantile("arr_delay", 0.95), 1).alias("p95_arr_delay"),
            round_to(F.when(n > 1, deviation), 2).alias("stddev_arr_delay"),
            pct(F.sum("cancelled"), total).alias("cancel_rate_pct"),
        )
        .filter(F.col("total_flights") >= min_flights)
    )
    scored = composite_score(by_route, weights, "severity_score", 4).withColumn(
        "severity_rank", position_by(*desc("severity_score"), *asc("route"))
    )
    if limit is not None:
        scored = scored.filter(F.col("severity_rank") <= limit)
    cities = airports.select("iata_code", "city")
    start = cities.toDF("origin", "origin_city")
    end = cities.toDF("dest", "dest_city")
    return (
        scored.join(start, "origin", "left")
        .join(end, "dest", "left")
        .select(
            "severity_rank",
            "route",
            F.concat("origin_city", F.lit(" -> "), "dest_city").alias("city_pair"),
            "total_flights",
            "delay_rate_pct",
            "avg_delay_when_late",
            "p95_arr_delay",
            "stddev_arr_delay",
            "cancel_rate_pct",
            "severity_score",
        )
        .orderBy("severity_rank")
    )


def severity_distribution(flights: DataFrame) -> DataFrame:
    buckets = (
        flights.filter((F.col("cancelled") == 0) & F.col("arr_delay").isNotNull())
        .groupBy(bucket_of("arr_delay", DELAY_BUCKETS).alias("delay_bucket"))
        .agg(m.flights().alias("flights"))
    )
    so_far = over_all("delay_bucket").rowsBetween(Window.unboundedPreceding, 0)
    running = F.sum("flights").over(so_far)
    everything = F.sum("flights").over(over_all())
    return buckets.select(
        "delay_bucket",
        "flights",
        share_of_total("flights", 2).alias("pct_of_total"),
        pct(running, everything).alias("cumulative_pct"),
    ).orderBy("delay_bucket")


def carrier_momentum(flights: DataFrame, carriers: DataFrame) -> DataFrame:
    """Slope of the monthly late share per carrier. Months of different years fold together."""
    monthly = (
        flights.filter(F.col("cancelled") == 0)
        .groupBy("carrier_code", "month")
        .agg(m.delay_rate_arr15().alias("rate"))
        .withColumn("units", in_units(F.col("rate"), 2))
    )
    by_carrier = monthly.groupBy("carrier_code").agg(
        F.count("month").alias("months_observed"),
        rounded_mean(F.sum("units"), F.count("units"), 2).alias("avg_delay_rate"),
        F.min("rate").alias("best_month_rate"),
        F.max("rate").alias("worst_month_rate"),
        F.min_by("rate", "month").alias("first_month_rate"),
        F.max_by("rate", "month").alias("last_month_rate"),
        round_to(F.regr_slope("rate", "month"), 4).alias("trend_slope"),
    )
    slope = F.col("trend_slope")
    # Labels and their limits.
    direction = (
        F.when(slope < -0.5, "Strongly Improving")
        .when(slope < -0.1, "Improving")
        .when(slope > 0.5, "Strongly Degrading")
        .when(slope > 0.1, "Degrading")
        .otherwise("Stable")
    )
    return (
        with_carrier(by_carrier, carriers)
        .select(
            "carrier_code",
            "carrier_name",
            "months_observed",
            "avg_delay_rate",
            "best_month_rate",
            "worst_month_rate",
            "first_month_rate",
            "last_month_rate",
            "trend_slope",
            direction.alias("trend_direction"),
            rank_by(*asc("trend_slope")).alias("improvement_rank"),
        )
        .orderBy(*asc("trend_slope", "carrier_code"))
    )
