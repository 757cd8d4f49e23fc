"""The data behind each chart of the analysis reports; drawing is left to the reader."""

from __future__ import annotations


from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger.functions import measures as m
from skyledger.functions.fixed_values import (
    CAUSE_LABELS,
    DAY_ABBREVIATIONS,
    HOLIDAY_WINDOWS,
    MAJOR_HUBS,
    SEVERITY_BUCKETS,
    WEEK_LABELS,
)
from skyledger.functions.labels import bucket_of, label_of
from skyledger.functions.numeric import asc, desc, ratio, round_to
from skyledger.operators.longform import rows_from_columns
from skyledger.operators.lookup import with_airport
from skyledger.operators.quantiles import (
    WEIGHT,
    count_values,
    quantile,
    weighted_mean,
    whiskers,
)
from skyledger.operators.sampling import row_hash, sample_rows
from skyledger.operators.scoring import over_all
from skyledger.operators.topk import top_k

# The columns of the correlation matrix, in order.
CORRELATED = (
    "arr_delay_minutes",
    "dep_delay_minutes",
    "distance",
    *CAUSE_LABELS,
)


# Columns that make up a flight, for samples by hash.
SAMPLED_BY = (
    "flight_date", "carrier_code", "origin", "dest", "crs_dep_time", "dep_delay", "arr_delay",
    "distance",
)


def _profile(*extra: Column) -> list[Column]:
    """Mean delay, share of delayed flights and count, unrounded."""
    return [
        F.avg("arr_delay_minutes").alias("avg_delay"),
        m.delay_share_flag().alias("delay_rate"),
        m.flights().alias("flights"),
        *extra,
    ]


# Distribution of delays


def delay_histogram(
    flights: DataFrame, low: float = -60, high: float = 180, width: int = 5
) -> DataFrame:
    bin_start = (F.floor(F.col("arr_delay_minutes") / width) * width).cast("double")
    return (
        flights.filter(F.col("arr_delay_minutes").between(low, high))
        .groupBy(bin_start.alias("bin"))
        .agg(m.flights().alias("cnt"))
        .orderBy("bin")
    )


def delay_stats(flights: DataFrame) -> DataFrame:
    known = flights.filter(F.col("arr_delay_minutes").isNotNull())
    return count_values(known, [], "arr_delay_minutes").agg(
        weighted_mean("arr_delay_minutes").alias("mean_delay"),
        quantile("arr_delay_minutes", 0.5).alias("median_delay"),
        quantile("arr_delay_minutes", 0.95).alias("p95_delay"),
        F.max("arr_delay_minutes").alias("max_delay"),
        F.coalesce(F.sum(WEIGHT), F.lit(0).cast("long")).alias("n"),
    )


def delay_box(flights: DataFrame, low: float = -60, high: float = 180) -> DataFrame:
    in_range = flights.filter(F.col("arr_delay_minutes").between(low, high))
    box = count_values(in_range, [], "arr_delay_minutes").agg(*_box("arr_delay_minutes"))
    whisker_lo, whisker_hi = whiskers("q1", "q3", "minv", "maxv")
    return box.withColumns({"whisker_lo": whisker_lo, "whisker_hi": whisker_hi})


def _box(value: str) -> list[Column]:
    return [
        quantile(value, 0.25).alias("q1"),
        quantile(value, 0.5).alias("median"),
        quantile(value, 0.75).alias("q3"),
        F.min(value).alias("minv"),
        F.max(value).alias("maxv"),
    ]


def correlation_matrix(
    flights: DataFrame,
    columns: tuple[str, ...] = CORRELATED,
    sample: int | None = None,
    seed: int = 42,
) -> DataFrame:
    """Pearson r of every pair, each over the rows where both are known.

    Every row gives a small record per left column, which is combined at once into the running
    correlations with all columns to the right.  By default every row counts; pass
    ``sample=50_000`` for the sampled figure.
    """
    rows = flights if sample is None else sample_rows(flights, sample, seed)
    left = [
        F.struct(F.lit(a).alias("col_a"), F.lit(i).alias("i"), F.col(a).alias("x"))
        for i, a in enumerate(columns[:-1])
    ]
    wide = (
        rows.select(*columns, F.inline(F.array(*left)))
        .groupBy("col_a", "i")
        .agg(*[round_to(F.corr("x", b), 4).alias(b) for b in columns[1:]])
    )
    right = [
        F.struct(F.lit(b).alias("col_b"), F.lit(j).alias("j"), F.col(b).alias("r"))
        for j, b in enumerate(columns[1:], 1)
    ]
    long = wide.select("col_a", "i", F.inline(F.array(*right)))
    return long.filter(F.col("j") > F.col("i")).select("col_a", "col_b", "r")


def missing_values(df: DataFrame) -> DataFrame:
    """Percentage of nulls of every column that has any, smallest first."""
    counts = df.agg(
        m.flights().alias("__rows"), *[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns]
    )
    long = rows_from_columns(
        counts,
        [
            {
                "column": F.lit(c),
                "missing_pct": ratio(F.col(c), F.col("__rows")) * F.lit(100.0),
            }
            for c in df.columns
        ],
    )
    return long.filter(F.col("missing_pct") > 0).orderBy(*asc("missing_pct", "column"))


def daily_volume(flights: DataFrame, width: int = 7) -> DataFrame:
    """Flights per day with a centred mean that is null unless its window is full."""
    daily = flights.groupBy("flight_date").agg(m.flights().alias("flights"))
    reach = width // 2
    centred = over_all("flight_date").rowsBetween(-reach, reach)
    full = F.count("flights").over(centred) == width
    return daily.withColumn("ma7", F.when(full, F.avg("flights").over(centred))).orderBy(
        "flight_date"
    )


def peak_day(flights: DataFrame) -> DataFrame:
    """The busiest day (the earliest of equals) and the mean flights per day."""
    daily = flights.groupBy("flight_date").agg(m.flights().alias("n"))
    order = F.struct(-F.col("n"), "flight_date")
    return daily.agg(
        F.min_by("flight_date", order).alias("peak_date"),
        F.max("n").alias("peak_flights"),
        F.avg("n").alias("avg_daily_flights"),
    )


# Carriers


def carrier_delay_rates(flights: DataFrame) -> DataFrame:
    by_carrier = flights.groupBy("carrier_code").agg(
        m.flights().alias("total"),
        F.count_if(F.col("is_delayed") == 1).alias("delayed"),
        m.delay_share_flag().alias("delay_rate"),
    )
    median = F.percentile("delay_rate", F.lit(0.5)).over(over_all())
    mean = F.avg("delay_rate").over(over_all())
    return by_carrier.withColumns(
        {
            "above_median": (F.col("delay_rate") > median).cast("int"),
            "mean_rate": round_to(mean, 6),
        }
    ).orderBy(*asc("delay_rate", "carrier_code"))


def _known_pairs(flights: DataFrame) -> DataFrame:
    return flights.filter(
        F.col("dep_delay_minutes").isNotNull() & F.col("arr_delay_minutes").isNotNull()
    )


def departure_arrival_sample(flights: DataFrame, n: int = 5000) -> DataFrame:
    """``n`` (departure, arrival) delay pairs: those of the rows with the lowest hashes.

    The hash covers the columns that make up a flight, so the sample is the same on every run
    and every cluster; each task passes on its own ``n`` lowest only.
    """
    key = row_hash(SAMPLED_BY)
    return top_k(
        _known_pairs(flights).select("dep_delay_minutes", "arr_delay_minutes", key.alias("key")),
        asc("key"),
        n,
    ).drop("key")


def axis_limit(flights: DataFrame, q: float = 0.99) -> DataFrame:
    """The larger of the two delays' upper quantiles over all flights with both."""
    known = _known_pairs(flights)
    limits = [
        count_values(known, [], c).agg(quantile(c, q).alias("at"))
        for c in ("dep_delay_minutes", "arr_delay_minutes")
    ]
    return limits[0].union(limits[1]).agg(F.max("at").alias("axis_limit"))


def departure_arrival_correlation(flights: DataFrame) -> DataFrame:
    return flights.agg(round_to(F.corr("dep_delay_minutes", "arr_delay_minutes"), 4).alias("r"))


def dataset_overview(flights: DataFrame) -> DataFrame:
    return flights.agg(
        m.flights().alias("rows"),
        F.min("flight_date").alias("date_min"),
        F.max("flight_date").alias("date_max"),
        F.countDistinct("carrier_code").alias("carriers"),
        F.countDistinct("origin").alias("origins"),
        F.countDistinct("dest").alias("dests"),
        F.sum("cancelled").alias("cancelled"),
        (F.avg("cancelled") * 100).alias("cancel_pct"),
        F.sum("is_delayed").alias("delayed"),
        (F.avg("is_delayed") * 100).alias("delay_pct"),
    )


# Time of day, causes, severity


def hourly_profile(flights: DataFrame) -> DataFrame:
    """Every flight by scheduled hour, cancelled ones included."""
    return (
        flights.groupBy("hour_of_day")
        .agg(*_profile())
        .select("hour_of_day", "avg_delay", "delay_rate", "flights")
        .orderBy(*asc("hour_of_day"))
    )


def peak_hour(flights: DataFrame) -> DataFrame:
    """The hour with the largest mean delay (the earliest of equals)."""
    order = F.struct(-F.col("avg_delay"), "hour_of_day")
    return hourly_profile(flights).agg(
        F.min_by("hour_of_day", order).alias("hour_of_day"),
        F.max("avg_delay").alias("avg_delay"),
    )


def cause_shares(flights: DataFrame) -> DataFrame:
    """Minutes and share of each cause over all flights."""
    totals = flights.agg(*[F.coalesce(F.sum(c), F.lit(0.0)).alias(c) for c in CAUSE_LABELS])
    long = rows_from_columns(
        totals,
        [{"cause": F.lit(label), "minutes": F.col(c)} for c, label in CAUSE_LABELS.items()],
    )
    grand = F.sum("minutes").over(over_all())
    return long.withColumn("share", F.try_divide(F.col("minutes"), grand) * F.lit(100.0))


def carrier_cause_means(flights: DataFrame) -> DataFrame:
    return (
        flights.groupBy("carrier_code")
        .agg(*[F.avg(c).alias(c) for c in CAUSE_LABELS])
        .orderBy(*desc("carrier_delay"), *asc("carrier_code"))
    )


def _delayed_within(flights: DataFrame, cap: float) -> DataFrame:
    return flights.filter((F.col("is_delayed") == 1) & (F.col("arr_delay_minutes") <= cap))


def carrier_delay_boxes(flights: DataFrame, cap: float = 180) -> DataFrame:
    counted = count_values(_delayed_within(flights, cap), ["carrier_code"], "arr_delay_minutes")
    boxes = counted.groupBy("carrier_code").agg(
        *_box("arr_delay_minutes"), F.sum(WEIGHT).alias("n")
    )
    whislo, whishi = whiskers("q1", "q3", "minv", "maxv")
    return boxes.withColumns({"whislo": whislo, "whishi": whishi}).orderBy(
        *desc("median"), *asc("carrier_code")
    )


def delayed_median(flights: DataFrame, cap: float = 180) -> DataFrame:
    counted = count_values(_delayed_within(flights, cap), [], "arr_delay_minutes")
    return counted.agg(quantile("arr_delay_minutes", 0.5).alias("med"))


def severity_breakdown(flights: DataFrame) -> DataFrame:
    """Flights per severity bucket in fixed order; a bucket without flights has a null count.

    A flight of exactly 15 minutes is Minor here although it counts as delayed.
    """
    bucketed = flights.filter(F.col("arr_delay_minutes").isNotNull()).select(
        bucket_of("arr_delay_minutes", SEVERITY_BUCKETS).alias("severity")
    )
    counts = bucketed.agg(
        *[
            F.nullif(F.count_if(F.col("severity") == name), F.lit(0)).alias(name)
            for _, name in SEVERITY_BUCKETS
        ]
    )
    long = rows_from_columns(
        counts,
        [{"severity": F.lit(name), "cnt": F.col(f"`{name}`")} for _, name in SEVERITY_BUCKETS],
    )
    total = F.sum("cnt").over(over_all())
    return long.withColumn("pct", ratio(F.col("cnt"), total) * F.lit(100.0))


def severe_total(flights: DataFrame) -> DataFrame:
    """Flights in the two most severe buckets, and their percentage."""
    known = F.col("arr_delay_minutes").isNotNull()
    severe = F.count_if(F.col("arr_delay_minutes") > 60)
    return flights.agg(
        severe.alias("severe_count"),
        (ratio(severe, F.count_if(known)) * F.lit(100.0)).alias("severe_pct"),
    )


# Calendar profiles


def monthly_profile(flights: DataFrame) -> DataFrame:
    return (
        flights.groupBy("month")
        .agg(*_profile())
        .select("month", "avg_delay", "delay_rate", "flights")
        .orderBy("month")
    )


def monthly_trend(flights: DataFrame) -> DataFrame:
    """Monthly profile with the departure side."""
    return (
        flights.groupBy("month")
        .agg(*_profile(F.avg("dep_delay_minutes").alias("avg_dep_delay")))
        .orderBy("month")
    )


def weekend_profile(flights: DataFrame) -> DataFrame:
    return (
        flights.groupBy("is_weekend")
        .agg(*_profile(F.avg("dep_delay_minutes").alias("avg_dep_delay")))
        .orderBy("is_weekend")
    )


def _by_weekday(flights: DataFrame) -> DataFrame:
    return (
        flights.groupBy("day_of_week")
        .agg(*_profile())
        .withColumn("day_name", label_of("day_of_week", DAY_ABBREVIATIONS))
        .orderBy("day_of_week")
    )


def day_of_week_profile(flights: DataFrame) -> DataFrame:
    return _by_weekday(flights).select("day_of_week", "day_name", "avg_delay", "delay_rate")


def day_of_week_pattern(flights: DataFrame) -> DataFrame:
    """Weekday profile with its volume."""
    return _by_weekday(flights).select(
        "day_of_week", "day_name", "avg_delay", "delay_rate", "flights"
    )


def day_hour_matrix(flights: DataFrame) -> DataFrame:
    """Mean arrival delay: a row per weekday and a column ``h0`` to ``h23`` per hour."""
    wide = (
        flights.groupBy("day_of_week")
        .pivot("hour_of_day", list(range(24)))
        .agg(F.avg("arr_delay_minutes"))
    )
    return wide.select(
        "day_of_week", *[F.col(f"`{hour}`").alias(f"h{hour}") for hour in range(24)]
    ).orderBy("day_of_week")


def weekly_trend(flights: DataFrame, labels: dict[int, str] = WEEK_LABELS) -> DataFrame:
    """Weeks from Monday with ISO numbers; the first week of each labelled number is named."""
    weekly = flights.groupBy(
        F.date_trunc("week", "flight_date").cast("date").alias("week_start"),
        F.weekofyear("flight_date").alias("week_num"),
    ).agg(*_profile())
    first = F.min("week_start").over(over_all().partitionBy("week_num"))
    label = F.when(F.col("week_start") == first, label_of("week_num", labels))
    return weekly.select(
        "week_start", "week_num", "delay_rate", "avg_delay", "flights", label.alias("label")
    ).orderBy("week_start")


def holiday_periods(
    flights: DataFrame, windows: list[tuple[str, str, str]] = HOLIDAY_WINDOWS
) -> DataFrame:
    """Delay in named date windows against all flights.

    Flights are added up per day first; each day then counts once for the
    baseline and once for every window that contains it.
    """
    daily = flights.groupBy("flight_date").agg(
        m.flights().alias("n"),
        F.sum("is_delayed").alias("delayed"),
        F.sum("arr_delay_minutes").alias("minutes"),
        F.count("arr_delay_minutes").alias("known"),
    )
    inside = [
        F.when(
            F.col("flight_date").between(F.lit(start).cast("date"), F.lit(end).cast("date")), name
        )
        for name, start, end in windows
    ]
    everything = F.lit("")
    periods = F.explode(F.array_compact(F.array(everything, *inside)))
    by_period = (
        daily.withColumn("period", periods)
        .groupBy("period")
        .agg(
            F.sum("n").alias("flights"),
            ratio(F.sum("delayed"), F.sum("n")).alias("delay_rate"),
            ratio(F.sum("minutes"), F.sum("known")).alias("avg_delay"),
        )
    )
    baseline = F.max(F.when(F.col("period") == everything, F.col("delay_rate"))).over(over_all())
    return (
        by_period.withColumn("baseline_rate", baseline)
        .withColumn("above_baseline", (F.col("delay_rate") > F.col("baseline_rate")).cast("int"))
        .filter(F.col("period") != everything)
    )


# Airports


def _by_origin(flights: DataFrame, min_flights: int = 0, *extra: Column) -> DataFrame:
    return (
        flights.groupBy("origin").agg(*_profile(*extra)).filter(F.col("flights") >= min_flights)
    )


def busiest_airports(flights: DataFrame, limit: int = 20) -> DataFrame:
    """Departures plus arrivals; an airport seen on one side only has zero on the other."""
    # One scan: pairs of airports are counted, and each pair then counts for both its ends.
    pairs = flights.groupBy("origin", "dest").agg(m.flights().alias("n"))
    zero = F.lit(0).cast("long")
    ends = F.array(
        F.struct(F.col("origin").alias("airport"), F.col("n").alias("out"), zero.alias("back")),
        F.struct(F.col("dest").alias("airport"), zero.alias("out"), F.col("n").alias("back")),
    )
    both = (
        pairs.select(F.inline(ends))
        .filter(F.col("airport").isNotNull())
        .groupBy("airport")
        .agg(F.sum("out").alias("departures"), F.sum("back").alias("arrivals"))
    )
    total = both.withColumn("total", F.col("departures") + F.col("arrivals"))
    return top_k(total, [*desc("total"), *asc("airport")], limit)


def most_delayed_airports(
    flights: DataFrame, min_flights: int = 5000, limit: int = 20
) -> DataFrame:
    rows = _by_origin(flights, min_flights)
    return top_k(rows, [*desc("delay_rate"), *asc("origin")], limit).select(
        "origin", "flights", "delay_rate", "avg_delay"
    )


def airport_quadrants(
    flights: DataFrame, min_flights: int = 2000, labelled: int | None = None
) -> DataFrame:
    """Origins split at the medians of volume and delay rate.

    With ``labelled`` only that many of the largest are returned.
    """
    rows = _by_origin(flights, min_flights)

    def side(column: str, above: str, below: str) -> Column:
        median = F.percentile(column, F.lit(0.5)).over(over_all())
        return F.when(F.col(column) > median, above).otherwise(below)

    quadrant = F.concat_ws(
        " / ",
        side("flights", "high volume", "low volume"),
        side("delay_rate", "high delay", "low delay"),
    )
    split = rows.select("origin", "flights", "delay_rate", "avg_delay", quadrant.alias("quadrant"))
    return top_k(split, [*desc("flights"), *asc("origin")], labelled)


def hub_comparison(flights: DataFrame, hubs: list[str] = MAJOR_HUBS) -> DataFrame:
    chosen = flights.filter(F.col("origin").isin(hubs))
    rows = _by_origin(
        chosen,
        0,
        F.avg("dep_delay_minutes").alias("avg_dep_delay"),
        m.cancel_share().alias("cancel_rate"),
    )
    return rows.select(
        "origin", "flights", "delay_rate", "avg_delay", "avg_dep_delay", "cancel_rate"
    ).orderBy(*desc("delay_rate"), *asc("origin"))


def geographic_delay(
    flights: DataFrame, airports: DataFrame, min_flights: int = 500, labelled: int | None = None
) -> DataFrame:
    """Origins inside the continental box that have coordinates."""
    located = airports.filter(
        (F.col("longitude") > -130)
        & (F.col("longitude") < -65)
        & (F.col("latitude") > 24)
        & (F.col("latitude") < 50)
    )
    rows = with_airport(
        _by_origin(flights, min_flights), located, "longitude", "latitude", code="origin"
    ).filter(F.col("longitude").isNotNull())
    return top_k(
        rows.select("origin", "flights", "delay_rate", "avg_delay", "longitude", "latitude"),
        [*desc("flights"), *asc("origin")],
        labelled,
    )
