"""Named datasets and report tables, written as distributed files."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from skyledger.functions.numeric import asc, desc
from skyledger.plans import reports, service
from skyledger.sources.sinks import write_table


def overview(flights, carriers, airports) -> DataFrame:
    return service.overview(flights)


def carriers_dataset(flights, carriers, airports) -> DataFrame:
    rates = service.carrier_rates(flights, carriers)
    return rates.orderBy(*desc("on_time_pct"), *asc("carrier_code"))


def airports_dataset(flights, carriers, airports) -> DataFrame:
    rows = service.airport_delays(flights, airports)
    return rows.orderBy(*desc("delay_rate"), *asc("airport_code"))


def hourly(flights, carriers, airports) -> DataFrame:
    return service.delays_by_hour(flights)


def causes(flights, carriers, airports) -> DataFrame:
    return service.cause_minutes(flights).orderBy(*desc("total_minutes"), *asc("cause"))


def trends(flights, carriers, airports) -> DataFrame:
    return service.monthly_trends(flights)


def cancellations(flights, carriers, airports) -> DataFrame:
    counts = service.cancellation_counts(flights)
    return counts.orderBy(*desc("count"), *asc("cancellation_code"))


DATASETS: dict[str, Callable[[DataFrame, DataFrame, DataFrame], DataFrame]] = {
    "overview": overview,
    "carriers": carriers_dataset,
    "airports": airports_dataset,
    "hourly": hourly,
    "causes": causes,
    "trends": trends,
    "cancellations": cancellations,
}


def dataset(
    name: str,
    flights: DataFrame,
    carriers: DataFrame,
    airports: DataFrame,
    max_rows: int | None = None,
) -> DataFrame:
    """A dataset by name, whole unless ``max_rows`` is given; an unknown name is refused."""
    if name not in DATASETS:
        raise ValueError(f"Unknown dataset {name!r}. Available: {sorted(DATASETS)}")
    rows = DATASETS[name](flights, carriers, airports)
    return rows if max_rows is None else rows.limit(max_rows)


def export_dataset(
    name: str,
    path: str,
    flights: DataFrame,
    carriers: DataFrame,
    airports: DataFrame,
    file_format: str = "csv",
) -> None:
    """Write a dataset as CSV with a header, or as one JSON object per line."""
    write_table(dataset(name, flights, carriers, airports), path, file_format)


def report_tables(
    flights: DataFrame, carriers: DataFrame, airports: DataFrame
) -> dict[str, DataFrame]:
    return {
        "Summary": reports.summary(flights),
        "Hourly_Delays": reports.hourly(flights),
        "Carrier_Performance": reports.carrier_performance(flights, carriers),
        "Airport_Performance": reports.airport_performance(flights, airports),
        "Monthly_Trends": reports.monthly(flights),
        "Delay_Causes": reports.delay_causes(flights),
    }


def export_report(
    folder: str,
    flights: DataFrame,
    carriers: DataFrame,
    airports: DataFrame,
    file_format: str = "csv",
) -> list[str]:
    """Write the report as one folder per table and return their paths."""
    paths = []
    for name, table in report_tables(flights, carriers, airports).items():
        path = f"{folder.rstrip('/')}/{name}"
        write_table(table, path, file_format)
        paths.append(path)
    return paths
