"""Raw on-time-performance files -> typed flights with derived columns."""

from __future__ import annotations

import csv
import re
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.functions.fixed_values import CAUSE_LABELS, RAW_TO_COLUMN
from skyledger.sources.schema import DERIVED, DOUBLE_COLUMNS, INT_COLUMNS, SOURCE_COLUMNS

DATE_FORMATS = (
    "M/d/yyyy h:mm:ss a",
    "yyyy-MM-dd",
    "yyyy-MM-dd HH:mm:ss",
    "M/d/yyyy",
    "M/d/yyyy H:mm",
)
DELAYED_FROM_MINUTES = 15


def read_raw_csv(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Scan raw files as text columns, each file by its own header; nothing is inferred.

    Files are grouped by their first line, and a column that a group lacks is null there. First
    lines are read from the start of each file that a scan would list, a few kB a file, and no
    job runs for them.
    """
    groups: dict[str, list[str]] = {}
    files = sorted(spark.read.text(path).inputFiles())
    for file, header in zip(files, first_lines(spark, files), strict=True):
        if header is not None:
            groups.setdefault(header, []).append(file)
    scans = [_scan_with_header(spark, groups[header], header) for header in sorted(groups)]
    if not scans:
        return spark.read.csv(path, header=True, inferSchema=False)
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), scans)


def first_lines(spark: SparkSession, files: list[str], at_once: int = 16) -> list[str | None]:
    """The first line of each file, None for an empty one; compressed ones are known by their suffix."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    codecs = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf)

    def first_line(file: str) -> str | None:
        place = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(file))
        stream = place.getFileSystem(conf).open(place)
        try:
            codec = codecs.getCodec(place)
            read = codec.createInputStream(stream) if codec else stream
            return jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(read, "UTF-8")).readLine()
        finally:
            stream.close()

    with ThreadPoolExecutor(at_once) as pool:
        return list(pool.map(first_line, files))


def _scan_with_header(spark: SparkSession, files: list[str], header: str) -> DataFrame:
    """Files that share a header line; a blank or repeated name gets its place as a suffix."""
    names: list[str] = []
    for place, name in enumerate(next(csv.reader([header]), [])):
        plain = name.strip().lstrip("\ufeff")
        names.append(plain if plain and plain not in names else f"{plain}_c{place}")
    schema = ", ".join(f"`{name.replace('`', '``')}` string" for name in names)
    # Listed names are URIs; paths for a reader are plain, and their marks of patterns escaped.
    jvm = spark._jvm
    plain = [jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(file)).toString() for file in files]
    paths = [re.sub(r"([\\{}\[\]*?])", r"\\\1", path) for path in plain]
    return spark.read.csv(paths, header=True, schema=schema)


def clean(raw: DataFrame) -> DataFrame:
    """Rename, type and derive. Columns outside the known header are dropped.

    A known column missing from the files comes out as nulls, so every batch
    has the same schema. Values that do not parse become null.
    """
    renamed = raw.withColumnsRenamed(RAW_TO_COLUMN)
    present = set(renamed.columns)
    typed = [
        (_typed(name) if name in present else F.lit(None).cast(kind)).alias(name)
        for name, kind in SOURCE_COLUMNS.items()
    ]
    return derive(renamed.select(*typed))


def _typed(name: str) -> Column:
    text = F.col(name)
    if name == "flight_date":
        return parse_date(text)
    if name in INT_COLUMNS:
        return _number(text).try_cast("int")
    if name in DOUBLE_COLUMNS:
        return _number(text)
    return text


def _number(text: Column) -> Column:
    return F.nullif(F.trim(text).try_cast("double"), F.lit(float("nan")))


def parse_date(text: Column) -> Column:
    """Month-first dates in any of the known layouts; null if none fits."""
    text = F.trim(text)
    return F.coalesce(*[F.try_to_timestamp(text, F.lit(f)) for f in DATE_FORMATS]).cast("date")


def derive(flights: DataFrame) -> DataFrame:
    """Add the eight derived columns. Narrow: every value comes from its own row."""
    minutes = {name: F.coalesce(F.col(name), F.lit(0.0)) for name in CAUSE_LABELS}
    with_causes = flights.withColumns(
        {
            "largest_cause": F.greatest(*minutes.values()),
            "cause_minutes": reduce(Column.__add__, minutes.values()),
        }
    )
    explained = (F.col("arr_delay") >= DELAYED_FROM_MINUTES) & (F.col("cause_minutes") != 0)
    # The earlier cause wins a tie.
    largest = F.coalesce(
        *[
            F.when(minutes[name] == F.col("largest_cause"), F.lit(label))
            for name, label in CAUSE_LABELS.items()
        ]
    )
    return with_causes.withColumns(
        {
            "arr_del15": _late("arr_delay"),
            "dep_del15": _late("dep_delay"),
            "hour_of_day": F.when(
                F.col("crs_dep_time").isNotNull(),
                F.least(F.greatest(F.floor(F.col("crs_dep_time") / 100), F.lit(0)), F.lit(23)),
            ).cast("int"),
            "is_weekend": F.coalesce(F.col("day_of_week").isin(6, 7), F.lit(False)).cast("int"),
            "route": F.concat(F.col("origin"), F.lit("-"), F.col("dest")),
            "quarter": F.floor((F.col("month") + 2) / 3).cast("int"),
            "is_delayed": F.when(
                (F.col("cancelled") == 0) & (F.col("arr_delay") >= DELAYED_FROM_MINUTES), 1
            ).otherwise(0),
            "primary_delay_cause": F.when(explained, largest),
        }
    ).select(*flights.columns, *DERIVED)


def _late(delay: str) -> Column:
    return F.when(
        F.col(delay).isNotNull(), (F.col(delay) >= DELAYED_FROM_MINUTES).cast("int")
    )
