"""Session builder, shared work folder and capped SQL."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

def get_session(
    app_name: str = "skyledger",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    **conf: str,
) -> SparkSession:
    """A session with UTC dates and adaptive execution; ANSI mode stays on.

    On a cluster leave ``master`` and ``shuffle_partitions`` unset: adaptive
    execution coalesces and splits shuffle partitions by their size.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # The JVM never compiles a method above 8000 bytecodes; Spark then does
        # better with an operator's code split into small methods.
        .config("spark.sql.codegen.hugeMethodLimit", "8000")
    )
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@contextmanager
def small_methods(spark: SparkSession) -> Iterator[None]:
    """Plans made inside keep to methods that the JVM compiles, whatever the session's limit is."""
    name = "spark.sql.codegen.hugeMethodLimit"
    before = spark.conf.get(name)
    spark.conf.set(name, "8000")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def work_path(spark: SparkSession, label: str) -> str:
    """A fresh path for a written table in the folder all executors share.

    That is ``spark.checkpoint.dir``, or the warehouse where it is unset.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get(
        "spark.sql.warehouse.dir"
    )
    return f"{shared.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def write_shared(df: DataFrame, label: str) -> tuple[DataFrame, str]:
    """Write ``df`` to shared storage and read it back: the lineage ends at the files."""
    spark = df.sparkSession
    path = work_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def drop_paths(spark: SparkSession, paths: list[str]) -> None:
    """Remove tables that ``write_shared`` wrote and nothing reads any more."""
    jvm = spark._jvm
    for path in paths:
        place = jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def file_state(spark: SparkSession, path: str) -> str:
    """Sizes and times of the files under ``path``, as one text that changes with them."""
    jvm = spark._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    store = place.getFileSystem(spark._jsc.hadoopConfiguration())
    listed = [(s.getLen(), s.getModificationTime()) for s in store.listStatus(place)]
    return f"{len(listed)}/{hash(tuple(sorted(listed)))}"


def run_sql(
    spark: SparkSession, sql: str, args: dict | list | None = None, max_rows: int | None = None
) -> DataFrame:
    """Run a parameterised query; keep at most ``max_rows`` rows, in its own order, if given."""
    rows = spark.sql(sql, args=args)
    return rows if max_rows is None else rows.limit(max_rows)
