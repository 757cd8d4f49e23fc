"""Flight connections: the best few itineraries per start, destination and date.

The naive form joins every arrival at an airport with every later departure of
the day, which squares the traffic of a busy hub.  Two exact reductions come
first.  A leg is kept only if it is among the ``best`` for its route and minute,
and only if fewer than ``best`` other legs of the same route are at least as
good on both counts that matter: delay, and time (arriving no later for a first
leg, leaving no earlier for a last leg).  Any leg left out could be swapped for
one of those others in every itinerary without a worse total, so the result is
the same, and what is joined per hub and day is a short staircase per route.

With two legs there is no join. A leg stands twice in one table, as an arrival where it ends and
as a departure where it begins; equal ones are combined, both sides of a hub and day meet by one
shuffle of what is left, and of the pairs there only the ``best`` for each start and destination
move on: others over the same hub have the same path and no better total.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DAY_START = ["flight_date", "start_airport"]
#: Pairs of arrivals and departures that a task holds at once.
PAIRS = 1 << 20


def connections(
    flights: DataFrame,
    origin: str | None = "ATL",
    date: str | None = "2023-03-15",
    max_legs: int = 2,
    min_connect: int = 60,
    best: int = 3,
    clock_minutes: bool = False,
) -> DataFrame:
    """Best itineraries by total arrival delay, ties by fewer legs and then by path.

    ``origin`` and ``date`` restrict the search; None takes every origin and
    date.  ``min_connect`` is added to the HHMM clock number as it stands, so
    14:50 + 60 is 15:10; ``clock_minutes=True`` counts real minutes instead.
    The connection has to be strictly longer than ``min_connect``.
    """
    # Stated for both sides of the join, so that Spark computes the shared part once.
    placed = [F.col(c).isNotNull() for c in ("flight_date", "origin", "dest", "arr_time")]
    legs = flights.filter(reduce(Column.__and__, placed, F.col("cancelled") == 0))
    if date is not None:
        day = F.lit(date).cast("date")
        # The tables are laid out by year and month: the folders of other dates are not opened.
        folders = [F.col(c) == f(day) for c, f in (("year", F.year), ("month", F.month))
                   if c in flights.columns]
        legs = legs.filter(reduce(Column.__and__, folders, F.col("flight_date") == day))
    clock = _minutes if clock_minutes else F.col
    legs = legs.select(
        "flight_date",
        "origin",
        "dest",
        clock("dep_time").alias("leaves"),
        clock("arr_time").alias("arrives"),
        "arr_delay",
        F.coalesce("arr_delay", F.lit(0.0)).alias("added_delay"),
    )

    if max_legs == 2:
        return _two_legs(legs, origin, min_connect, best)
    first = legs if origin is None else legs.filter(F.col("origin") == origin)
    frontier = first.select(
        "flight_date",
        F.col("origin").alias("start_airport"),
        F.col("dest").alias("at"),
        F.concat_ws("-", "origin", "dest").alias("path"),
        F.lit(1).cast("long").alias("stops"),
        F.col("arrives").alias("last_arrival"),
        F.col("arr_delay").alias("total_delay"),
    )
    # The path is the same throughout a group here, so delay alone decides.
    frontier = _undominated_arrivals(frontier, _delay(), best)
    found = frontier

    for leg_number in range(2, max_legs + 1):
        last = leg_number == max_legs
        onward = _undominated_departures(legs, best) if last else _best_by_times(legs, best)
        onward = onward.select(
            "flight_date",
            F.col("origin").alias("at"),
            F.col("dest").alias("next"),
            "leaves",
            "arrives",
            "added_delay",
        )
        frontier = (
            frontier.join(onward, ["flight_date", "at"])
            .filter(F.col("leaves") > F.col("last_arrival") + F.lit(min_connect))
            .select(
                *DAY_START,
                F.col("next").alias("at"),
                F.concat_ws(" -> ", "path", "next").alias("path"),
                F.lit(leg_number).cast("long").alias("stops"),
                F.col("arrives").alias("last_arrival"),
                (F.col("total_delay") + F.col("added_delay")).alias("total_delay"),
            )
        )
        if not last:
            by_delay_and_path = F.struct(_delay().alias("delay"), "path")
            frontier = _undominated_arrivals(frontier, by_delay_and_path, best)
        found = found.unionByName(frontier)

    in_order = Window.partitionBy(*DAY_START, "at").orderBy(
        F.col("total_delay").asc_nulls_last(), "stops", "path"
    )
    return (
        found.withColumn("route_rank", F.row_number().over(in_order))
        .filter(F.col("route_rank") <= best)
        .select(
            *DAY_START,
            F.col("at").alias("final_dest"),
            "path",
            "stops",
            "total_delay",
            F.col("route_rank").cast("long").alias("route_rank"),
        )
    )


def _two_legs(legs: DataFrame, origin: str | None, min_connect: int, best: int) -> DataFrame:
    """Itineraries of one or two legs. ``time`` rises as a leg gets worse: departures have it negative."""

    def side(hub: str, other: str, inbound: bool, time: Column, cost: Column) -> Column:
        return F.struct(
            F.col(hub).alias("hub"), F.col(other).alias("other"), F.lit(inbound).alias("inbound"),
            time.alias("time"), cost.alias("cost"),
        )

    unknown = F.lit(float("inf"))
    sides = F.array(
        side("dest", "origin", True, F.col("arrives"), F.coalesce("arr_delay", unknown)),
        side("origin", "dest", False, -F.col("leaves"), F.col("added_delay")),
    )
    rows = legs.select("flight_date", F.inline(sides)).filter(F.col("time").isNotNull())
    if origin is not None:
        rows = rows.filter(~F.col("inbound") | (F.col("other") == origin))
    route = ["flight_date", "hub", "inbound", "other"]
    # Copies are combined before the shuffle; more than ``best`` of one kind cannot matter.
    counted = rows.groupBy(*route, "time", "cost").agg(F.count(F.lit(1)).alias("n"))
    copies = F.explode(F.array_repeat(F.lit(0), F.least("n", F.lit(best)).cast("int"))).alias("copy")
    dealt = counted.repartition("flight_date", "hub").select(*route, "time", "cost", copies)
    kept = _staircase(dealt.drop("copy"), route, F.col("time").asc(), best)

    def meet(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _hub_pairs(key, pa.Table.from_batches(list(batches)), min_connect, best)

    hubs = kept.select("flight_date", "hub", "other", "inbound", "time", "cost")
    found = hubs.groupBy("flight_date", "hub").applyInArrow(
        meet, "flight_date date, start_airport string, final_dest string, via string, total double"
    )
    # Of equal totals the direct one is first, then the order of the hubs is that of the paths.
    in_order = Window.partitionBy(*DAY_START, "final_dest").orderBy(
        F.col("total").asc(), F.col("via").asc_nulls_first()
    )
    ranked = found.withColumn("place", F.row_number().over(in_order)).filter(F.col("place") <= best)
    through = F.when(F.col("via").isNotNull(), F.concat_ws(" -> ", F.lit(""), "final_dest"))
    path = F.concat_ws("-", "start_airport", F.coalesce("via", "final_dest"))
    return ranked.select(
        *DAY_START,
        "final_dest",
        F.concat(path, F.coalesce(through, F.lit(""))).alias("path"),
        F.when(F.col("via").isNull(), 1).otherwise(2).cast("long").alias("stops"),
        F.nullif("total", unknown).alias("total_delay"),
        F.col("place").cast("long").alias("route_rank"),
    )


def _hub_pairs(
    key: tuple[pa.Scalar, ...], legs: pa.Table, min_connect: int, best: int
) -> Iterator[pa.RecordBatch]:
    """The ``best`` itineraries for each start and destination that end at a hub or change there."""
    day, hub = (k.as_py() for k in key)
    names = legs["other"].combine_chunks().dictionary_encode()
    other = names.indices.to_numpy().astype(np.int64)
    inbound = legs["inbound"].to_numpy().astype(bool)
    time, cost = (legs[c].to_numpy().astype(float) for c in ("time", "cost"))
    leaves, onward, dest = -time[~inbound], cost[~inbound], other[~inbound]
    arrivals = np.flatnonzero(inbound)
    arrivals = arrivals[np.argsort(other[arrivals], kind="stable")]
    n = len(names.dictionary)

    def rows(start: np.ndarray, last: np.ndarray | None, total: np.ndarray) -> pa.RecordBatch:
        pair = start if last is None else start * n + last
        order = np.lexsort((total, pair))
        # A row is one of the best if the one so many places before it is of another pair.
        ahead = pair[order]
        kept = order[np.concatenate([np.ones(min(best, len(order)), bool), ahead[best:] != ahead[:-best]])]
        alike = [hub] * len(kept)
        ends = alike if last is None else names.dictionary.take(pa.array(last[kept]))
        return pa.RecordBatch.from_arrays(
            [pa.array([day] * len(kept), pa.date32()), names.dictionary.take(pa.array(start[kept])),
             pa.array(ends, pa.string()), pa.array([None] * len(kept) if last is None else alike, pa.string()),
             pa.array(total[kept])],
            names=[*DAY_START, "final_dest", "via", "total"],
        )

    if len(arrivals):
        yield rows(other[arrivals], None, cost[arrivals])
    step = max(1, PAIRS // max(1, len(leaves)))
    for at in range(0, len(arrivals), step):
        some = arrivals[at : at + step]
        first, second = np.nonzero(leaves > time[some][:, None] + min_connect)
        if len(first):
            yield rows(other[some][first], dest[second], cost[some][first] + onward[second])


def _minutes(clock: str) -> Column:
    hours = F.floor(F.col(clock) / 100)
    return (hours * 60 + F.col(clock) - hours * 100).alias(clock)


def _delay() -> Column:
    """Total delay so far; an unknown one is worse than any other."""
    return F.coalesce("total_delay", F.lit(float("inf")))


def _undominated_arrivals(frontier: DataFrame, cost: Column, depth: int) -> DataFrame:
    group = [*DAY_START, "at"]
    kept = _first_rows(
        frontier.withColumn("cost", cost), [*group, "last_arrival"], F.col("cost"), depth
    )
    return _staircase(kept, group, F.col("last_arrival").asc(), depth).drop("cost")


def _undominated_departures(legs: DataFrame, depth: int) -> DataFrame:
    group = ["flight_date", "origin", "dest"]
    costed = legs.withColumn("cost", F.col("added_delay"))
    kept = _first_rows(costed, [*group, "leaves"], F.col("cost"), depth)
    return _staircase(kept, group, F.col("leaves").desc(), depth).drop("cost")


def _best_by_times(legs: DataFrame, depth: int) -> DataFrame:
    times = ["flight_date", "origin", "dest", "leaves", "arrives"]
    return _first_rows(legs, times, F.col("added_delay"), depth)


def _first_rows(df: DataFrame, group: list[str], order: Column, n: int) -> DataFrame:
    """The first ``n`` rows of each group; Spark applies the limit before its shuffle too."""
    place = F.row_number().over(Window.partitionBy(*group).orderBy(order))
    return df.withColumn("place", place).filter(F.col("place") <= n).drop("place")


def _staircase(df: DataFrame, group: list[str], time: Column, depth: int) -> DataFrame:
    """Drop rows with at least ``depth`` others no worse in time and in cost.

    Each round marks the rows that beat every unmarked row before them.  A row
    still unmarked after ``depth`` rounds is beaten by one row of every round.
    The rounds share one shuffle and one sort.
    """
    in_time = Window.partitionBy(*group).orderBy(time, "cost")
    before = in_time.rowsBetween(Window.unboundedPreceding, -1)
    df = df.withColumn("round", F.lit(None).cast("int"))
    for number in range(depth):
        lowest = F.min(F.when(F.col("round").isNull(), F.col("cost"))).over(before)
        df = df.withColumn("lowest", lowest)
        wins = F.col("lowest").isNull() | (F.col("cost") < F.col("lowest"))
        df = df.withColumn(
            "round", F.coalesce("round", F.when(wins, F.lit(number)))
        )
    return df.filter(F.col("round").isNotNull()).drop("round", "lowest")
