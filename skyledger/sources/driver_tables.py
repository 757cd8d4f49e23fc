"""A flights-shaped view of the order tables, and the dimensions that go with it.

Every value is arithmetic on the keys of one line item, apart from the lookups
that give the two airports.  Those are left joins on unique keys, so they neither
add nor drop a flight.  No broadcast is forced, since orders, customers and
suppliers grow with the data: Spark broadcasts a side only while its size stays
under ``spark.sql.autoBroadcastJoinThreshold``.

The projected flights are written once per session and folder, as the load step
of any flights warehouse does.  Queries then scan that table, reading only their
columns and pushing their filters down to it.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.functions.fixed_values import CARRIER_NAMES, CAUSE_LABELS, RAW_TO_COLUMN
from skyledger.session import drop_paths, file_state, small_methods, work_path
from skyledger.sources.dimensions import calendar_dimension, carrier_names
from skyledger.sources.raw_flights import derive
from skyledger.sources.sinks import dealt, read_flights, write_flights, write_table

# One carrier code stays outside the carrier dimension.
UNKNOWN_CARRIER = "ZZ"
# One nation key stays outside the airport dimension.
AIRPORT_KEYS = 24
# Folders of the loaded table; within them files are in date order.
LOADED_BY = ("year",)

# Tables the flights are computed from.
LOADED_FROM = ("lineitem", "supplier", "orders", "customer")

_loaded: dict[tuple[str, str, str], DataFrame] = {}
_paths: dict[tuple[str, str, str], str] = {}


@dataclass(frozen=True)
class DriverTables:
    """Lazily built flights and dimensions over one folder of Parquet tables."""

    spark: SparkSession
    folder: str

    def read(self, table: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{table}.parquet")

    @property
    def flights(self) -> DataFrame:
        """The written flights table; the first use in a session loads it."""
        key = self._key("flights")
        if key not in _loaded:
            path = work_path(self.spark, "flights")
            keys = dealt(self._keys(), LOADED_BY)
            # The projection in one method would run uncompiled: 49 us a row in place of 16.
            with small_methods(self.spark):
                write_flights(derive(_fly(keys)), path, partition_by=LOADED_BY, deal=False)
            _loaded[key], _paths[key] = read_flights(self.spark, path), path
        return _loaded[key]

    def project_flights(self) -> DataFrame:
        """Flights computed from the order tables."""
        return derive(_fly(self._keys()))

    @property
    def airports(self) -> DataFrame:
        nation, region = self.read("nation"), self.read("region")
        key = F.col("n_nationkey")
        return (
            nation.filter(key < AIRPORT_KEYS)
            .join(region, nation.n_regionkey == region.r_regionkey)
            .select(
                F.concat(F.lit("N"), F.lpad(key.cast("string"), 2, "0")).alias("iata_code"),
                F.col("n_name").alias("airport_name"),
                (key + 25).cast("double").alias("latitude"),
                (key * 3 - 128).cast("double").alias("longitude"),
                F.lit("XX").alias("iso_country"),
                F.col("r_name").alias("iso_region"),
                F.col("n_name").alias("city"),
                F.lit("hub").alias("airport_type"),
            )
        )

    @property
    def carriers(self) -> DataFrame:
        return carrier_names(self.spark)

    @property
    def calendar(self) -> DataFrame:
        """The written calendar, one row per day; the first use in a session loads it."""
        key = self._key("calendar")
        if key not in _loaded:
            path = work_path(self.spark, "calendar")
            days = calendar_dimension(self.flights)
            write_table(days, path, "parquet")
            _loaded[key] = self.spark.read.schema(days.schema).parquet(path)
            _paths[key] = path
        return _loaded[key]

    def state(self, table: str) -> tuple[str, str, str]:
        """Session, table and the state of the files it is made from."""
        files = " ".join(file_state(self.spark, f"{self.folder}/{t}.parquet") for t in LOADED_FROM)
        return self.spark.sparkContext.applicationId, f"{self.folder}:{table}", files

    def _key(self, table: str) -> tuple[str, str, str]:
        """The state of a table; what an earlier state left in the shared folder is removed."""
        own = self.state(table)
        for key in [k for k in _loaded if k[:2] == own[:2] and k != own]:
            drop_paths(self.spark, [_paths.pop(key)])
            del _loaded[key]
        return own

    def _keys(self) -> DataFrame:
        """Date, carrier, both airport keys and the hash of a line item's keys.

        Seven narrow columns hold all that a flight is computed from, so this
        is the place to shuffle.
        """
        supplier = self.read("supplier").select(
            F.col("s_suppkey").alias("l_suppkey"), F.col("s_nationkey").alias("origin_key")
        )
        orders = self.read("orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
        customer = self.read("customer").select(
            F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("dest_key")
        )
        # Orders meet their customers first: line items, four times as many, are shuffled once.
        ordered = orders.join(customer, "o_custkey", "left")
        joined = (
            self.read("lineitem")
            .join(supplier, "l_suppkey", "left")
            .join(ordered, "l_orderkey", "left")
        )
        codes = ", ".join(f"'{code}'" for code in [*CARRIER_NAMES, UNKNOWN_CARRIER])
        return joined.selectExpr(
            "CAST(l_shipdate AS DATE) AS flight_date",
            f"element_at(array({codes}), CAST(l_suppkey % 16 AS INT) + 1) AS carrier_code",
            "origin_key",
            "dest_key",
            "31 * l_orderkey + 17 * l_partkey + 13 * l_suppkey"
            " + 7 * CAST(l_linenumber AS BIGINT) + 101 * CAST(l_quantity AS BIGINT) AS h",
        ).selectExpr("*", "year(flight_date) AS year", "month(flight_date) AS month")


def _airport(end: str) -> list[str]:
    key = f"CAST({end}_key AS STRING)"
    return [
        f"concat('N', lpad({key}, 2, '0')) AS {end}",
        f"concat('City ', {key}) AS {end}_city",
        f"concat('S', CAST({end}_key % 5 AS STRING)) AS {end}_state",
    ]


def _fly(keys: DataFrame) -> DataFrame:
    """Schedule, delays, clock times and causes from the hash."""
    scheduled = keys.selectExpr(
        "*",
        "h % 24 AS dep_hour",
        "(h DIV 24) % 60 AS dep_minute",
        "CAST(h % 41 = 0 AS INT) AS cancelled",
    )
    left = scheduled.selectExpr(
        "*",
        "IF(cancelled = 1, NULL, (h DIV 7) % 60 - 40 + dep_hour + IF(h % 53 = 0, 150, 0)) AS dep",
    )
    arrived = left.selectExpr(
        "*",
        "IF(h % 97 = 0, NULL, dep + h % 31 - 15) AS arr",
        "(dep_hour * 60 + dep_minute + dep + 1440) % 1440 AS left_at",
        "(dep_hour * 60 + dep_minute + 40 + h % 200) % 1440 AS due_at",
    )
    timed = arrived.selectExpr(
        "*",
        "IF(arr IS NULL, NULL, (left_at + 40 + h % 200) % 1440) AS in_at",
        "IF(arr >= 15, arr, NULL) AS late",
    )
    shared = timed.selectExpr(
        "*",
        "h % 5 AS main_cause",
        "CASE WHEN h % 89 = 0 THEN late * 0 WHEN h % 7 = 0 THEN late DIV 2 ELSE late DIV 3 END"
        " AS second_part",
        "CASE WHEN h % 89 = 0 THEN late * 0 WHEN h % 7 = 0 THEN late DIV 2"
        " ELSE late - late DIV 3 END AS main_part",
    )
    causes = [
        f"CAST(CASE main_cause WHEN {i} THEN main_part WHEN {(i + 3) % 5} THEN second_part"
        f" ELSE late * 0 END AS DOUBLE) AS {name}"
        for i, name in enumerate(CAUSE_LABELS)
    ]
    return shared.selectExpr(
        "year",
        "month",
        "CAST(day(flight_date) AS INT) AS day_of_month",
        "CAST(weekday(flight_date) + 1 AS INT) AS day_of_week",
        "flight_date", "carrier_code",
        *_airport("origin"),
        *_airport("dest"),
        "CAST(dep_hour * 100 + dep_minute AS DOUBLE) AS crs_dep_time",
        "CAST(left_at DIV 60 * 100 + left_at % 60 AS DOUBLE) AS dep_time",
        "CAST(dep AS DOUBLE) AS dep_delay",
        "CAST(IF(dep < 0, 0, dep) AS DOUBLE) AS dep_delay_minutes",
        "CAST(due_at DIV 60 * 100 + due_at % 60 AS DOUBLE) AS crs_arr_time",
        "CAST(in_at DIV 60 * 100 + in_at % 60 AS DOUBLE) AS arr_time",
        "CAST(arr AS DOUBLE) AS arr_delay",
        "CAST(IF(arr < 0, 0, arr) AS DOUBLE) AS arr_delay_minutes",
        "cancelled",
        "IF(cancelled = 1, substr('ABCD', CAST((h DIV 41) % 4 AS INT) + 1, 1), NULL)"
        " AS cancellation_code",
        "CAST(200 + h % 2400 AS DOUBLE) AS distance",
        *causes,
    )


# Layouts a date is written in, by day of the month; the first has the hour of the raw files.
DATE_LAYOUTS = (
    "M/d/yyyy' 12:00:00 AM'", "yyyy-MM-dd", "yyyy-MM-dd' 00:00:00'", "M/d/yyyy", "M/d/yyyy' 0:00'"
)
# Days of the month whose departure delay is written as text that is no number.
BAD_DAYS = (13, 27)


def raw_text(flights: DataFrame, odd: bool = False) -> DataFrame:
    """Flights written back as the text of a raw file, with its trailing blank column.

    ``odd`` deals the five date layouts over the days and spoils some numbers.
    """
    texts = []
    for header, name in RAW_TO_COLUMN.items():
        text = F.col(name).cast("string")
        if name == "flight_date":
            layouts = [F.date_format(name, f) for f in DATE_LAYOUTS]
            text = layouts[0]
            for place, layout in enumerate(layouts if odd else []):
                text = F.when(F.col("day_of_month") % len(layouts) == place, layout).otherwise(text)
        if odd and name == "dep_delay":
            text = F.when(F.col("day_of_month").isin(*BAD_DAYS), "n/a").otherwise(text)
        texts.append(text.alias(header))
    return flights.select(*texts, F.lit(None).cast("string").alias("_c28"))


def write_raw_files(flights: DataFrame, folder: str) -> None:
    """Raw CSV files of three headers, by month: as published, reversed, without the distance."""
    text = raw_text(flights, odd=True)
    month = F.col("MONTH").cast("int") % 3
    names = text.columns[:-1]
    variants = [text.withColumnRenamed("_c28", " "), text.select(*reversed(names)),
                text.select(*(c for c in names if c != "DISTANCE"))]
    for place, variant in enumerate(variants):
        variant.where(month == place).write.mode("append").csv(folder, header=True)


def write_airports_file(airports: DataFrame, folder: str) -> None:
    """Airports as a quoted CSV: every fourth code blank, commas and quotes in the names."""
    place = F.substring("iata_code", 2, 2).cast("int")
    airports.select(
        F.when(place % 4 == 3, F.when(place % 8 == 3, "  ")).otherwise(F.col("iata_code"))
        .alias("iata_code"),
        F.concat("airport_name", F.lit(', "'), "iso_region", F.lit('"')).alias("name"),
        F.col("latitude").cast("string").alias("latitude_deg"),
        F.when(place == 1, "west").otherwise(F.col("longitude").cast("string"))
        .alias("longitude_deg"),
        "iso_country",
        "iso_region",
        F.col("city").alias("municipality"),
        F.col("airport_type").alias("type"),
    ).write.csv(folder, header=True, quoteAll=True, escape='"', nullValue="", emptyValue="")
