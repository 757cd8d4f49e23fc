"""Aggregate measures over flights.

Delay and punctuality are defined in several ways that give different numbers;
each variant has its own function and none is a synonym of another.  All of
them are sums and counts, so Spark combines them before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from skyledger.functions.numeric import flag, pct, round_to


def completed() -> Column:
    return F.col("cancelled") == 0


def flights() -> Column:
    return F.count(F.lit(1))


def cancelled_count() -> Column:
    return F.count_if(F.col("cancelled") == 1)


def delayed_count() -> Column:
    """Flights whose known arrival delay is 15 minutes or more."""
    return F.count_if(F.col("arr_del15") == 1)


def mean(column: str, digits: int | None) -> Column:
    value = F.avg(column)
    return value if digits is None else round_to(value, digits)


def share_where(condition: Column, digits: int | None = 2) -> Column:
    """Percentage of rows in scope that meet the condition; unknown counts as not met."""
    value = F.lit(100.0) * F.avg(flag(condition))
    return value if digits is None else round_to(value, digits)


def delay_rate_arr15(digits: int | None = 2) -> Column:
    """Late arrivals as a percentage of every row in scope."""
    return share_where(F.col("arr_del15") == 1, digits)


def delay_rate_completed(digits: int = 2) -> Column:
    """Late arrivals as a percentage of flights that were not cancelled."""
    return pct(delayed_count(), F.count_if(completed()), digits)


def delay_rate_flag(digits: int | None = 2) -> Column:
    """Sum of ``is_delayed`` over every row in scope, as a percentage."""
    return pct(F.sum("is_delayed"), flights(), digits)


def delay_share_flag() -> Column:
    """Mean of ``is_delayed`` as a ratio, unrounded."""
    return F.avg(flag(F.col("is_delayed") == 1))


def on_time_complement(digits: int = 2) -> Column:
    """One minus the late share over all rows, so a cancelled flight counts as on time."""
    late = F.avg(flag(F.col("arr_del15") == 1))
    return round_to(F.lit(100.0) * (F.lit(1.0) - late), digits)


def on_time_arr0(digits: int = 2) -> Column:
    """Known on-time arrivals over all rows in scope; a diverted flight is not on time."""
    return pct(F.count_if(F.col("arr_del15") == 0), flights(), digits)


def on_time_api(digits: int | None = 2) -> Column:
    """Neither delayed nor cancelled, over all rows; a diverted flight counts as on time."""
    good = F.count_if((F.col("is_delayed") == 0) & completed())
    return pct(good, flights(), digits)


def cancel_rate(digits: int | None = 2) -> Column:
    """Cancelled flights as a percentage of every row in scope."""
    return share_where(F.col("cancelled") == 1, digits)


def cancel_rate_by_count(digits: int = 2) -> Column:
    return pct(cancelled_count(), flights(), digits)


def avg_delay_positive(digits: int = 2) -> Column:
    """Mean arrival delay over flights that arrived late by any amount."""
    late = F.when(F.col("arr_delay_minutes") > 0, F.col("arr_delay_minutes"))
    return round_to(F.avg(late), digits)


def avg_delay_minutes(digits: int | None = 1) -> Column:
    """Mean of the non-negative arrival delay, zeros included."""
    return mean("arr_delay_minutes", digits)


def cancel_share() -> Column:
    """Cancelled flights as a ratio of every row in scope, unrounded."""
    return F.avg(flag(F.col("cancelled") == 1))
